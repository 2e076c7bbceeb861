"""Benchmark decontamination: pigeonhole pieces, exact hits, Myers' bit-parallel distance.

Texts and items are compared in a plain form: lower case, everything but letters and digits
as one blank. An item of n characters may differ by ``budget(n)`` edits. It is cut into one
piece more than that, so a passage within the budget holds at least one piece unchanged.
An automaton over all pieces finds exact hits in one pass over a text; around each hit the
item is compared with the text by Myers' algorithm, whose bit vectors are Python integers of
any length. Items are handed to the tasks in blocks of bounded size, one pass over the
documents for each block, so a benchmark of any size works.

Defined results: null or empty texts hold nothing; items without a letter or digit match
nothing; repeated items are reported each; a document is reported once for each item with the
smallest distance found. Rows without an identifier are reported with a null one and never
dropped. Passages of any text length are found at any place, empty tables give empty results,
and other columns are passed through (``drop_contaminated``) or not read (``find``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutiny.llm.common import stored, text_slices, texts_of

BUDGET_SHARE = 0.06  # edits for each character of an item
BLOCK_CHARS = 4 << 20  # characters of items that a task holds at once
OTHER = re.compile(r"[\W_]+")
ASCII_FORM = "".join(
    chr(c) if chr(c).isalnum() else " " for c in range(128)).lower()


def plain(text: str) -> str:
    """The form in which texts are compared."""
    if text.isascii():
        return " ".join(text.translate(ASCII_FORM).split())
    return OTHER.sub(" ", text.lower()).strip()


def budget(n: int, share: float = BUDGET_SHARE) -> int:
    return int(n * share)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of about equal length, with their places."""
    n = errors + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def peq(pattern: str) -> dict[str, int]:
    """For each character a bit vector of its places in the pattern."""
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def best_distance(masks: dict[str, int], m: int, text: str, most: int) -> int | None:
    """The least edit distance of the pattern to any part of ``text``; None if over ``most``."""
    if most >= m:
        return m
    ones, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = ones, 0, m, most + 1
    for left, c in zip(range(len(text) - 1, -1, -1), text):
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | ~(xh | plus) & ones
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best = score
                if not best:
                    return 0
        if score - left > most and best > most:
            return None  # too few characters left
        ph = ph << 1 & ones
        mh = mh << 1 & ones
        plus = mh | ~(xv | ph) & ones
        minus = ph & xv
    return best if best <= most else None


class Matcher:
    """The pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], share: float):
        import ahocorasick

        self.items = []
        owners: dict[str, list[tuple[int, int]]] = {}
        for key, text in items:
            form = plain(text)
            if not form:
                continue
            errors = budget(len(form), share)
            number = len(self.items)
            self.items.append((key, len(form), errors, peq(form), form))
            for at, piece in pieces(form, errors):
                owners.setdefault(piece, []).append((number, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in owners.items():
            self.automaton.add_word(piece, (len(piece), where))
        if owners:
            self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, int]:
        """Item number to the least distance, for items within their budget."""
        if not self.items:
            return {}
        spans: dict[int, list[list[int]]] = {}
        for end, (size, where) in self.automaton.iter(text):
            for number, at in where:
                _, m, errors, _, _ = self.items[number]
                low = end + 1 - size - at - errors
                high = low + m + 2 * errors
                own = spans.setdefault(number, [])
                if own and low <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], high)
                    own[-1][0] = min(own[-1][0], low)
                else:
                    own.append([low, high])
        found = {}
        for number, own in spans.items():
            _, m, errors, masks, form = self.items[number]
            for low, high in own:
                part = text[max(0, low):high]
                d = 0 if form in part else best_distance(masks, m, part, errors)
                if d is not None and d < found.get(number, errors + 1):
                    found[number] = d
        return found


def find(docs: DataFrame, items: DataFrame, share: float = BUDGET_SHARE,
         block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, distance`` of documents that hold an item within its budget."""
    forms = (items.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
             .where("text is not null"))
    each = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = [each.mapInArrow(_searching(block, share), "doc_id bigint, item_id bigint, distance int")
             for block in item_blocks(forms, block_chars)]
    if not found:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, distance int")
    return reduce(DataFrame.unionByName, found)


def item_blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Blocks of items of about that many characters; the driver holds one at a time."""
    block, size = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        if block and size + len(row["text"]) > block_chars:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
    if block:
        yield block


def _searching(block: list[tuple[int, str]], share: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block, share)
        for batch in text_slices(batches, "text"):
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                if text:
                    out += [(doc, matcher.items[n][0], d) for n, d in matcher.find(plain(text)).items()]
            docs, keys, bits = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(keys, pa.int64()), pa.array(bits, pa.int32())],
                ["doc_id", "item_id", "distance"])

    return rows


def drop_contaminated(docs: DataFrame, items: DataFrame, share: float = BUDGET_SHARE) -> DataFrame:
    """``docs``, all columns, without documents that hold an item."""
    found = stored(find(docs, items, share).select("doc_id").distinct(), "contaminated")
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
