"""How state steps keep many small things under few keys.

A call to the state store costs the same for one small value as for some hundred, and
a micro-batch of a large stream meets nearly every address.  So a step goes to the
state once per page or bucket that it meets, not once per entry or address:

* ``Pages``: entries (outpoints that are unspent or that a spend is pending for) as
  text, a line to an entry, dealt to pages by their hash.  A few entries of a page are
  looked up and cut out of its text, more are taken apart into a dictionary.
* ``PackedMap``: records under their key as a map state has them, ``BUCKET`` of them
  on average in one value.

Pages and buckets double in number when they have grown to twice their size.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator
from json.encoder import encode_basestring_ascii

import pandas as pd

#: Entries of a page, on average, when they are dealt anew.
PAGE = 256
#: Records of a bucket, on average, when they are dealt anew.
BUCKET = 32
#: Look-ups in a page's text before it is taken apart.
FEW = 8


def line_start(*names) -> str:
    """The line of an entry, named by texts and an index, up to its value: JSON, so
    that no name holds a line's end."""
    return f"[{','.join(['null' if n is None else encode_basestring_ascii(n) for n in names[:-1]])},{names[-1]},"


class Pages:
    """``size`` entries in ``pages`` pages (a power of two), the text of which
    ``load(page)`` gives, None for an empty one."""

    def __init__(self, load: Callable[[int], str | None], pages: int = 1, size: int = 0) -> None:
        self.load, self.pages, self.size = load, pages, size
        self.text: dict[int, str] = {}
        self.lines: dict[int, dict[str, str]] = {}  # of a page that is taken apart: start -> rest of the line
        self.looked: dict[int, int] = {}
        self.dirty: set[int] = set()

    def page(self, start: str) -> int:
        return zlib.crc32(start.encode()) & (self.pages - 1) if self.pages > 1 else 0

    def _text(self, page: int) -> str:
        if page not in self.text:
            self.text[page] = self.load(page) or ""
        return self.text[page]

    def _apart(self, page: int) -> dict[str, str]:
        if page not in self.lines:
            found = self.lines[page] = {}
            for line in self._text(page).split("\n")[1:]:
                at = line.rfind(",", 0, line.rfind(",", 0, line.rfind(","))) + 1
                found[line[:at]] = line[at:]
            self.text[page] = ""
        return self.lines[page]

    def _place(self, page: int, start: str) -> tuple[int, int] | None:
        """Where the entry's line lies in the text of its page."""
        text = self._text(page)
        at = text.find("\n" + start) if text else -1
        if at < 0:
            return None
        end = text.find("\n", at + 1)
        return at, len(text) if end < 0 else end

    def get(self, start: str) -> tuple[int, int, bool] | None:
        page = self.page(start)
        looked = self.looked[page] = self.looked.get(page, 0) + 1
        if looked > FEW or page in self.lines:
            rest = self._apart(page).get(start)
        else:
            place = self._place(page, start)
            rest = None if place is None else self.text[page][place[0] + 1 + len(start):place[1]]
        if rest is None:
            return None
        units, since, pending = rest[:-1].split(",")
        return int(units), int(since), pending == "true"

    def put(self, start: str, value: tuple, new: bool) -> None:
        self._drop(start, new)
        page = self.page(start)
        rest = f"{value[0]},{value[1]},{'true' if value[2] else 'false'}]"
        if page in self.lines:
            self.lines[page][start] = rest
        else:
            self.text[page] = f"{self._text(page)}\n{start}{rest}"
        self.size += new
        self.dirty.add(page)

    def remove(self, start: str) -> None:
        self._drop(start, False)
        self.size -= 1
        self.dirty.add(self.page(start))

    def _drop(self, start: str, new: bool) -> None:
        page = self.page(start)
        looked = self.looked[page] = self.looked.get(page, 0) + 1
        if looked > FEW:
            self._apart(page)
        if page in self.lines:
            self.lines[page].pop(start, None)
        elif not new and (place := self._place(page, start)):
            text = self.text[page]
            self.text[page] = text[:place[0]] + text[place[1]:]

    def changed(self) -> Iterator[tuple[int, str | None]]:
        """Pages to be written, with their text, None for one that is empty now."""
        if self.size > 2 * PAGE * self.pages:  # deal the entries anew, to twice as many pages at least
            held = [x for page in range(self.pages) for x in self._apart(page).items()]
            while self.size > PAGE * self.pages:
                self.pages *= 2
            self.text, self.lines, self.dirty = {}, {page: {} for page in range(self.pages)}, set(range(self.pages))
            for start, rest in held:
                self.lines[self.page(start)][start] = rest
        for page in sorted(self.dirty):
            yield page, self.content(page)

    def content(self, page: int) -> str | None:
        lines = self.lines.get(page)
        return (self._text(page) if lines is None else "".join([f"\n{start}{rest}" for start, rest in lines.items()])) or None


class PackedMap:
    """The part of a map state's interface that the steps use, over ``state``, a map of
    buckets (``bucket int`` -> ``packed binary``; -1 has the numbers of records and
    buckets).  What is changed is written by ``flush``, at the end of a key's rows."""

    KEY, VALUE = "bucket int", "packed binary"

    def __init__(self, state) -> None:
        self.state = state
        self._forget()

    def _forget(self) -> None:
        self.numbers: list[int] | None = None
        self.buckets: dict[int, dict] = {}
        self.dirty: set[int] = set()

    def _begin(self) -> list[int]:
        if self.numbers is None:
            stored = self.state.getValue((-1,))
            self.numbers = [0, 1] if stored is None else list(pickle.loads(stored[0]))
        return self.numbers

    def _bucket(self, key: tuple) -> int:
        buckets = self._begin()[1]
        return zlib.crc32(repr(key).encode("utf-8", "surrogatepass")) & (buckets - 1) if buckets > 1 else 0

    def _load(self, bucket: int) -> dict:
        if bucket not in self.buckets:
            stored = self.state.getValue((bucket,)) if self._begin()[0] else None
            self.buckets[bucket] = {} if stored is None else pickle.loads(stored[0])
        return self.buckets[bucket]

    def exists(self) -> bool:
        return self._begin()[0] > 0

    def getValue(self, key: tuple) -> tuple | None:
        return self._load(self._bucket(key)).get(key)

    def updateValue(self, key: tuple, value: tuple) -> None:
        bucket = self._bucket(key)
        held = self._load(bucket)
        self.numbers[0] += key not in held
        held[key] = value
        self.dirty.add(bucket)

    def removeKey(self, key: tuple) -> None:
        bucket = self._bucket(key)
        self.numbers[0] -= self._load(bucket).pop(key, None) is not None
        self.dirty.add(bucket)

    def flush(self) -> None:
        if self.dirty:
            records, buckets = self.numbers
            if records > 2 * BUCKET * buckets:  # deal the records anew, to twice as many buckets at least
                held = [x for bucket in range(buckets) for x in self._load(bucket).items()]
                while records > BUCKET * buckets:
                    buckets *= 2
                self.numbers, self.buckets, self.dirty = [records, buckets], {b: {} for b in range(buckets)}, set(range(buckets))
                for key, value in held:
                    self.buckets[self._bucket(key)][key] = value
            for bucket in sorted(self.dirty):
                if self.buckets[bucket]:
                    self.state.updateValue((bucket,), (pickle.dumps(self.buckets[bucket], 5),))
                else:
                    self.state.removeKey((bucket,))
            self.state.updateValue((-1,), (pickle.dumps(tuple(self.numbers)),))
        self._forget()


def unpack_entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The address and the text of entries of every account record in ``packed``."""
    for batch in batches:
        for packed in batch["packed"]:
            found = [(address, record[5]) for (address, _), record in pickle.loads(packed).items() if record[5]]
            yield pd.DataFrame(found, columns=["address", "entries"])


# Worker code travels by value with the task (no package install needed).
from utxoflow.session import pickle_by_value  # noqa: E402

pickle_by_value(__name__)
