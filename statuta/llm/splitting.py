"""Splitting of oversized texts by recursive bisection.

A text over the limit is cut at the strongest natural boundary near its
midpoint, and each half that still exceeds the limit minus the overlap is cut
again.  Afterwards every piece but the first is given the last ``overlap``
characters of the piece before.  Sizes are counted in Unicode code points.

Defined results: null and blank texts that fit give one piece holding the text
as it is (a null text gives no piece); a text of exactly ``limit`` characters
is not cut; where a stretch has no boundary that leaves an eighth of a piece on
both sides it is cut at its midpoint.
Joining the pieces without their overlaps restores the text exactly.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 2000
OVERLAP = 150

# Boundaries of a statute's text, strongest first.  Each pattern matches at
# the first character of the following part.
BOUNDARIES = [
    r"(?<=\n)(?=\s*부\s*칙)|(?<=\n)(?=[ \t]*\[?<?(?:별표|별지)\s*(?:제?\d))",
    r"(?<=[\n.。] )(?=제\d+조(?:의\d+)?\s*\()|(?<=\n)(?=[ \t]*제\d+(?:조|장|절|관)(?:의\d+)?)",
    r"(?<=\n)(?=[ \t\r]*\n)|(?<=\n\n)(?=\S)",
    r"(?<=[\n ])(?=[①-⑳㉑-㉟])",
    r"(?<=\n)(?=[ \t]*\d+(?:의\d+)?\.\s)",
    r"(?<=\n)(?=[ \t]*[가-하]\.\s)",
    r"(?<=[\n\v\f\x1c-\x1e\x85\u2028\u2029])",
    r"(?<=[.!?。！？][ \t])(?=\S)|(?<=[。！？])(?=\S)",
    r"(?<=[,;:，、；] )(?=\S)",
    r"(?<=\s)(?=\S)",
]
_BOUNDARIES = [re.compile(p) for p in BOUNDARIES]

#: How far from the midpoint a boundary may lie, as a share of the stretch.
REACH = 0.25

# Characters that belong to the one before them; no hard cut parts them.
_JOINED = re.compile(r"[\u0300-\u036f\u200d\ufe00-\ufe0f\u1160-\u11ff]")


def _boundaries(text: str) -> list[list[int]]:
    return [[m.start() for m in p.finditer(text)] for p in _BOUNDARIES]


def _cut(text: str, ranked: list[list[int]], start: int, end: int, least: int) -> int:
    """The strongest boundary of ``text[start:end]`` near its midpoint, or, if
    there is none near, the strongest one that leaves ``least`` on both sides."""
    middle = (start + end) // 2
    for reach in (max(1, int((end - start) * REACH)), middle - start - least):
        for positions in ranked:
            k = bisect_left(positions, middle)
            near = [p for p in positions[max(0, k - 1) : k + 1] if start < p < end and abs(p - middle) <= reach]
            if near:
                return min(near, key=lambda p: (abs(p - middle), p))
    cut = middle
    while cut > start + 1 and _JOINED.match(text, cut):
        cut -= 1
    return cut


def bisect_spans(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Consecutive spans that cover ``text``, none over ``limit - overlap`` if cut at all."""
    if not 0 <= 2 * overlap < limit:
        raise ValueError("the overlap must be less than half of the limit")
    if len(text) <= limit:
        return [(0, len(text))]
    ranked, room = _boundaries(text), limit - overlap
    spans: list[tuple[int, int]] = []
    stack = [(0, len(text))]
    while stack:
        start, end = stack.pop()
        if end - start <= room:
            spans.append((start, end))
            continue
        cut = _cut(text, ranked, start, end, room // 8)
        stack += [(cut, end), (start, cut)]
    return spans


def split_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, str]]:
    """(start, end, piece) of each piece; ``text[start:end]`` is its own part."""
    pieces: list[tuple[int, int, str]] = []
    for start, end in bisect_spans(text, limit, overlap):
        before = pieces[-1][2][-overlap:] if pieces and overlap else ""
        pieces.append((start, end, before + text[start:end]))
    return pieces


def split_oversized(
    rows: DataFrame, id_col: str = "unit_id", text_col: str = "text", limit: int = LIMIT, overlap: int = OVERLAP
) -> DataFrame:
    """Pieces of all texts: id, piece_no (from 1), n_pieces, start_pos, end_pos, piece.

    Texts within the limit never leave the JVM; only the others are sent to
    Python, so the cost follows the amount of oversized text.
    """
    id_type = rows.schema[id_col].dataType.simpleString()
    base = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    schema = f"id {id_type}, piece_no int, n_pieces int, start_pos int, end_pos int, piece string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, body in zip(frame["id"], frame["body"]):
                pieces = split_text(body, limit, overlap)
                out += [(key, k, len(pieces), s, e, p) for k, (s, e, p) in enumerate(pieces, 1)]
            yield pd.DataFrame(out, columns=["id", "piece_no", "n_pieces", "start_pos", "end_pos", "piece"])

    size = F.length("body")
    small = base.where(size <= limit).select(
        "id",
        F.lit(1).alias("piece_no"),
        F.lit(1).alias("n_pieces"),
        F.lit(0).alias("start_pos"),
        size.alias("end_pos"),
        F.col("body").alias("piece"),
    )
    large = base.where(size > limit).mapInPandas(run, schema)
    return small.unionByName(large).withColumnRenamed("id", id_col)


def oversized(
    rows: DataFrame, id_col: str = "unit_id", text_col: str = "text", limit: int = LIMIT, overlap: int = OVERLAP
) -> DataFrame:
    """Ids of the rows that the operator had to cut."""
    pieces = split_oversized(rows, id_col, text_col, limit, overlap)
    return pieces.where((F.col("n_pieces") > 1) & (F.col("piece_no") == 1)).select(id_col)
