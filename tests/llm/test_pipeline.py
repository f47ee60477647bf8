from __future__ import annotations

import random
import subprocess
import sys

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
import tiktoken

from utxoflow.llm import quality_rules, secret_scan
from utxoflow.llm.common import staged, table, tiktoken_ranks
from utxoflow.llm.queries import ORACLE, QUERIES

from .test_dedup import WS, jaccard_model

SF = "/root/testdata/sf0.001"


def test_pipeline_against_plain_steps(spark):
    """Stage by stage, each judged on the input it had."""
    docs = table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs_in, docs = docs, staged(stage(spark, docs, SF), "test")
        out.append((docs_in.collect(), docs.collect()))
        if name != names[-1]:
            assert docs.columns == docs_in.columns

    before, after = out[0]
    verdict = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(table(spark, SF, "documents")).collect()}
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before if verdict[r["doc_id"]]) and len(after) < len(before)

    before, after = out[1]
    best = {}
    for r in before:
        best.setdefault(WS.sub("", r["text"]), []).append((-len(r["text"]), r["doc_id"]))
    assert sorted(r["doc_id"] for r in after) == sorted(min(v)[1] for v in best.values())

    before, after = out[2]
    classes = {c for _, _, c in jaccard_model([(r["doc_id"], r["text"]) for r in before])}
    assert {r["doc_id"] for r in after} == classes and len(after) == len(classes)

    before, after = out[3]
    texts = {r["doc_id"]: r for r in after}
    encoding = secret_scan.tokenizer(secret_scan.default_vocabulary())
    assert len(after) == len(before)
    for r in before:
        want = secret_scan.redacted(r["text"], secret_scan.all_spans(r["text"], encoding, 2.25), "[secret]")
        assert texts[r["doc_id"]]["text"] == want and texts[r["doc_id"]]["n_chars"] == len(want)

    before, after = out[4]
    total = {}
    for r in after:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_tokens"]
    ranks = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, special_tokens={},
                              mergeable_ranks=tiktoken_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    assert total == {r["doc_id"]: len(ranks.encode_ordinary(r["text"])) for r in before}
    ran = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r["doc_id"], r["piece"], r["n_tokens"]) for r in ran) == sorted((r["doc_id"], r["piece"], r["n_tokens"]) for r in after)


def test_pipeline_on_edge_rows(spark, docs, no_docs, tmp_path):
    """Null, empty, very long and repeated rows, null ids, clashing columns; and
    no rows at all."""
    rng = random.Random(6)
    words = [f"word{i}" for i in range(400)]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randint(80, 200))) + "." for _ in range(12)]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    extra = [(100 + i, t) for i, t in enumerate(prose + prose[:3] + [prose[4] + " tail", long])] + [(None, prose[5]), (None, prose[6]), (100, prose[7])]
    rows = docs.unionByName(spark.createDataFrame(extra, "doc_id bigint, text string"), allowMissingColumns=True)
    rows.write.parquet(f"{tmp_path}/a/documents.parquet")
    no_docs.write.parquet(f"{tmp_path}/b/documents.parquet")
    out = corpus_pipeline.run(spark, f"{tmp_path}/a").collect()
    pieces = {}
    for r in out:
        pieces.setdefault(r["doc_id"], []).append((r["piece_start"], r["n_tokens"]))
    ranks = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, special_tokens={},
                              mergeable_ranks=tiktoken_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    size = {t: len(ranks.encode_ordinary(t)) for _, t in extra}
    assert sum(n for _, n in pieces[116]) == size[long] and len(pieces[116]) == -(-size[long] // 4096)
    # One row of each class of exact and near copies; the twelve texts are no copies of each other.
    short = sorted(n for k, v in pieces.items() for _, n in v if k is None or (100 <= k < 116))
    assert short == sorted(size[t] if t != prose[4] else size[kept_of(out, size, prose)] for t in prose)
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").collect() == []


def kept_of(out, size, prose):
    """Which of a text and its near copy stayed."""
    counts = [r["n_tokens"] for r in out]
    return prose[4] if size[prose[4]] in counts else prose[4] + " tail"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = ", ".join(sorted(got.columns))
    rows = con.sql(f"SELECT {columns} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(str, rows)) == sorted(str(tuple(r)) for r in got.select(*sorted(got.columns)).collect())


def test_entry_imports_without_the_subpackage():
    code = ("import sys; sys.modules['utxoflow.llm'] = None; import __spark_entry__ as e; q = e.queries(); "
            "assert not [k for k in q if k.startswith('op') or k == 'pipeline'] and len(q) > 40 and e.oracle_sql()")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rsplit("/", 1)[0])
