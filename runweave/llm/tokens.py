"""Token counts of parts of documents, from one encoding of the whole text.

The text is encoded once, as it is; its tokens have character spans, and these meet the spans of
fields or sections in an interval join. A token on a border is allotted by a rule that the caller names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.llm.bpe import encoder, vocabulary
from runweave.llm.common import map_arrow, text_batches

#: How a token that belongs to several parts is allotted: to the part with its first character, to that
#: with most of its characters (the earlier of equals), or to each in proportion to its characters.
RULES = ("first", "most", "share")


@lru_cache(maxsize=4)
def _sizes(rank_file: bytes) -> np.ndarray:
    """Bytes of each token."""
    return np.array([len(t) if t is not None else 0 for t in vocabulary(rank_file).token], np.int64)


def token_spans(text: str, rank_file: bytes, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last character of each token; tokens that share a character both cover it."""
    return _spans(text, encoder(rank_file, pattern).encode([text])[0], _sizes(rank_file))


def _spans(text: str, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans of the tokens ``ids`` that a text was encoded to, by the bytes of each token."""
    ends = np.cumsum(size[ids])
    starts = ends - size[ids]
    raw = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1  # number of the character that each byte is part of
    return (char[starts], char[ends - 1] + 1) if len(ids) else (starts, ends)


def allot(
    starts: np.ndarray, ends: np.ndarray, begin: np.ndarray, end: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each part ``[begin, end)`` and how many of them cross its border.

    Tokens are in order, so the ones that meet a part are a range, found by bisection; only the pairs of
    a token and a part that meet are looked at. Parts may overlap, and leave gaps; each token goes to
    parts that it meets, ``first`` to none if its first character is in none.
    """
    low = np.searchsorted(ends, begin, side="right")
    high = np.maximum(low, np.searchsorted(starts, end, side="left"))
    n = np.where(end > begin, high - low, 0)
    part = np.repeat(np.arange(len(begin)), n)
    token = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    common = np.minimum(ends[token], end[part]) - np.maximum(starts[token], begin[part])
    crosses = (starts[token] < begin[part]) | (ends[token] > end[part])
    if rule == "first":
        weight = ((starts[token] >= begin[part]) & (starts[token] < end[part])).astype(float)
    elif rule == "share":
        whole = np.bincount(token, common, minlength=len(starts))
        weight = common / whole[token]
    else:
        order = np.lexsort((begin[part], -common, token))
        top = np.ones(len(order), bool)
        top[1:] = token[order][1:] != token[order][:-1]
        weight = np.zeros(len(order))
        weight[order[top]] = 1.0
    count = np.bincount(part, weight, minlength=len(begin))
    return count, np.bincount(part, crosses & (weight > 0), minlength=len(begin)).astype(np.int64)


def attribute(
    docs: DataFrame,
    rank_file: bytes,
    pattern: str,
    rule: str = "most",
    sections: Callable[[str], list[dict]] | None = None,
) -> DataFrame:
    """``(row, doc_id, n_tokens, part, begin, end, tokens double, crossing)``: one row for each part of each row.

    ``row`` tells the rows of ``docs`` apart, whose ids may repeat.

    ``docs`` has ``doc_id``, ``text`` and, unless ``sections`` makes them from a text, ``parts``: an array of
    (part string, begin int, end int) in characters of the text, such as the fields a text was joined from. A row without parts gives one row with a null part; a null text has no tokens; an empty
    part has none; repeated rows give repeated results. Other columns are not looked at.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches):
        for batch in text_batches(batches, "text", 1 << 20):
            columns = [[] for _ in range(8)]
            rows = list(zip(*(column.to_pylist() for column in batch.columns)))
            # All texts of a batch at once: the matrices of the encoder want many pieces.
            encoded = encoder(rank_file, pattern).encode([r[2] for r in rows])
            for (row, doc, text, *parts), ids in zip(rows, encoded):
                parts = sections(text or "") if sections else parts[0]
                starts, ends = _spans(text or "", ids, _sizes(rank_file))
                parts = parts or [{"part": None, "begin": 0, "end": 0}]
                begin, end = (np.array([p[k] or 0 for p in parts], np.int64) for k in ("begin", "end"))
                count, crossing = allot(starts, ends, begin, end, rule)
                made = ([row] * len(parts), [doc] * len(parts), [len(starts)] * len(parts), [p["part"] for p in parts], begin, end, count, crossing)
                for column, values in zip(columns, made):
                    column.extend(values)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
            names = ["row", "doc_id", "n_tokens", "part", "begin", "end", "tokens", "crossing"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    row = F.monotonically_increasing_id().alias("row")
    docs = docs.select(row, F.col("doc_id").cast("bigint").alias("doc_id"), "text", *[] if sections else ["parts"])
    return map_arrow(
        docs, run,
        "row bigint, doc_id bigint, n_tokens bigint, part string, begin bigint, end bigint, tokens double, crossing bigint",
    )


def line_sections(text: str) -> list[dict]:
    """Sections of a text by its lines: ``head`` (the first line), ``table`` (lines with ``|``), ``body``.

    Neighbouring lines of a kind are one section; a line break belongs to the line before it.
    """
    out, at = [], 0
    for i, line in enumerate(text.split("\n")):
        part = "head" if i == 0 else "table" if "|" in line else "body"
        end = min(at + len(line) + 1, len(text))
        if out and out[-1]["part"] == part:
            out[-1]["end"] = end
        elif end > at:
            out.append({"part": part, "begin": at, "end": end})
        at = end
    return out


def by_kind(attributed: DataFrame) -> DataFrame:
    """``attributed`` summed by row and part name: how many parts, tokens and crossing tokens.

    Sums inside the tasks first. Rows with one id, alike or not, give results of their own, as do those
    without an id: ``n_tokens`` is that of the row's text, and the parts' tokens add up to it where they
    cover the text.
    """
    return attributed.groupBy("row", "doc_id", "part", "n_tokens").agg(
        F.count("part").alias("parts"),
        F.sum("tokens").alias("tokens"),
        F.sum("crossing").alias("crossing"),
    ).drop("row")
