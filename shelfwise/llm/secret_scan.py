"""Find secrets: all rules in one automaton, every byte of a text read once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm import tables, words
from shelfwise.llm.automaton import compile_rules, longest, starts


@dataclass(frozen=True)
class Rule:
    """``length``: least length of a match, ``tail``: of what follows the shortest prefix of it that matches, with its last byte."""

    kind: str
    pattern: str
    length: int = 0
    tail: int = 0


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
BASE = (
    Rule("assign", rf"""(?:{_NAMES})["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", tail=6),
    Rule("access", "AKIA[A-Z0-9]+", length=20),
    # A run shorter than 24 holds no longer one, so the least length can be part of the pattern.
    Rule("hex", "[0-9a-f]{24,}"),
)
MORE = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", length=40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", length=15),
    Rule("google", "AIza[A-Za-z0-9_-]+", length=39),
    Rule("live_key", "[sr]k_live_[A-Za-z0-9]+", length=20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", length=30),
    Rule("url_password", "[a-z]+://[A-Za-z0-9._-]+:[A-Za-z0-9._-]+@"),
)


@lru_cache(maxsize=4)
def _compiled(rules: tuple[Rule, ...]):
    patterns = [r.pattern for r in rules]
    return compile_rules(patterns, backwards=True, anywhere=True), [compile_rules([p]) for p in patterns]


def find(data: bytes, rules: tuple[Rule, ...], compiled=None) -> list[tuple[int, int, int]]:
    """(start, rule, end) of the leftmost non-overlapping longest matches of each rule, in bytes, ordered."""
    combined, single = compiled or _compiled(rules)
    at, spans = [0] * len(rules), []
    for position, state in reversed(starts(combined, data)):
        for k in combined.rules[state]:
            if position < at[k]:
                continue
            end, shortest = longest(single[k], data, position)
            at[k] = end
            if end - position >= rules[k].length and end - shortest + 1 >= rules[k].tail:
                spans.append((position, k, end))
    return sorted(spans)


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """Per row ``doc_id`` and ``spans``: ``kind``, ``start``, ``end`` in code points, by start and then by the rules' order.

    Matches of a rule are leftmost and do not overlap; a match that is too short is dropped after it has used up
    its text. Matches of different rules may overlap. A null text has no spans, ids may be null or repeat, an empty
    table gives an empty result, other columns are ignored. Matches hold ASCII only.
    """
    compiled = docs.sparkSession.sparkContext.broadcast(_compiled(rules))  # its size depends on the rules alone
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    out = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for part in words.slices(batch.column("text")):
                rows = []
                for i in range(part.n):
                    data = part.text(i)
                    found = find(data, rules, compiled.value)
                    if found and not data.isascii():
                        # A code point starts at every byte that does not continue one.
                        before = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
                        found = [(int(before[a]), k, int(before[b])) for a, k, b in found]
                    rows.append([{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in found])
                yield pa.RecordBatch.from_arrays([ids.slice(part.first, part.n), pa.array(rows, out[1].type)], schema=out)

    return tables.texts(docs, id_col, text_col).mapInArrow(scan, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
