"""Operators of a training-data pipeline: quality rules, exact and near
deduplication, secret and license scans, language id, byte-level BPE, packing,
WARC revisits and a quality classifier.  Nothing else in the package imports
this subpackage."""
