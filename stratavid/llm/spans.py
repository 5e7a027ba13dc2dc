"""Spans of whole texts as rows: what the searches for personal data and for secrets share."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavid.llm.tokens import slices

Span = tuple[str, int, int]  # kind, start, end (exclusive), in code points


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def in_order(spans: list[Span], kinds: tuple[str, ...]) -> list[Span]:
    """By start, then by kind as listed."""
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def apart(found: list[Span], base: list[Span]) -> list[Span]:
    """The spans of ``found`` that overlap none of ``base`` and no earlier one of themselves."""
    taken: list[list[int]] = []  # what base covers, in order and apart
    for s, e in sorted((s, e) for _, s, e in base):
        if taken and s < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([s, e])
    out, free, n = [], 0, 0
    for kind, start, end in sorted(found, key=lambda s: s[1]):
        while n < len(taken) and taken[n][1] <= start:
            n += 1
        if start >= free and (n == len(taken) or end <= taken[n][0]):
            out.append((kind, start, end))
            free = end
    return out


def span_rows(
    docs: DataFrame,
    kinds: tuple[str, ...],
    search: Callable[[list[str]], list[tuple[list[Span], list[Span]]]],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, base spans counted by kind, their digest, and all spans.

    ``search`` gets some texts and gives the base spans and all spans of each. Counts and digest
    are of the base spans. One pass, no shuffle.
    """
    counts = [f"n_{kind}" for kind in kinds]
    schema = f"doc_id long, {', '.join(f'{c} long' for c in counts)}, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = search([t or "" for t in part.column("text").to_pylist()])
                base = [in_order(b, kinds) for b, _ in found]
                columns = [part.column("doc_id")]
                columns += [pa.array([sum(s[0] == kind for s in b) for b in base], pa.int64()) for kind in kinds]
                columns.append(pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string()))
                columns.append(pa.array([joined(in_order(a, kinds)) for _, a in found], pa.string()))
                yield pa.record_batch(columns, ["doc_id", *counts, "base_sha256", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, schema)
