"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import decontaminate, fingerprints, language, lines, minhash, packing, quality, sharding, substrings, warc

MODULES = (minhash, language, lines, sharding, fingerprints, warc, substrings, decontaminate, quality, packing)
QUERIES: dict = {}
ORACLE: dict = {}
for _m in MODULES:
    QUERIES |= _m.QUERIES
    ORACLE |= _m.ORACLE
