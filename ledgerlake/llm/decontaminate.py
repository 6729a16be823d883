"""Benchmark decontamination by the q-gram lemma and banded alignment.

A text region within ``e`` edits of an item of ``m`` characters shares at
least ``m + 1 - q - q * e`` q-grams with it, all inside ``e + 1`` neighbouring
diagonals (text position minus item position). Diagonals are cut into bands of
``2 (e + 1)`` that overlap by half, so one band holds all of them. Bands with
that many common q-grams are kept, and a banded alignment of the whole item
over the band decides. The items are matched whole; A-Z are folded and each
separator counts as a blank. Nothing else of the text is changed, so spans are
character offsets of the original.

Texts are matched against the index of a block of items, which each task gets
as a few arrays of bounded size; a longer benchmark takes more passes. A task searches
texts in chunks of bounded size, gaps between them included, and counts common
q-grams in slices, so neither a long item nor a q-gram that is everywhere takes more memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import FOLD_AND_BLANK, small_batches, stage

Q = 8
RATE = 0.1  # edits per character of the item
BLOCK_CHARS = 2_000_000  # item characters of one pass
MASK_BITS = 22
CHUNK = 200_000  # characters searched as one array, gaps included (a longer text is one chunk)
SLICE = 1 << 20  # common q-grams counted at once
PASSES = 4  # blocks whose filters share a pass over the documents
GAP = 0xFFFFFFFF  # code between texts: no character, equal to nothing of an item

_B = np.uint64(0x9E3779B97F4A7C15)


def codes(text: str) -> np.ndarray:
    """Code points of the folded text, one per character."""
    raw = text.encode("utf-8", "surrogatepass").translate(FOLD_AND_BLANK)
    return np.frombuffer(raw.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def grams(x: np.ndarray, q: int = Q) -> np.ndarray:
    """64-bit hashes of the q-grams of a code array (q: a power of two)."""
    h = x.astype(np.uint64) * _B
    h ^= h >> np.uint64(29)
    width, factor = 1, 0xD6E8FEB86659FD93
    while width < q:
        if len(h) <= width:
            return np.empty(0, dtype=np.uint64)
        h = h[: len(h) - width] * np.uint64(factor) + h[width:]
        factor = (factor * factor + 2) % 2**64
        width *= 2
    h ^= h >> np.uint64(32)
    return h


def budget(m: int, q: int = Q, rate: float = RATE) -> int:
    """Edits allowed for an item of m characters: the rate, but no more than
    leaves one common q-gram by the lemma (0 for an item of up to 2q-1)."""
    return max(0, min(int(rate * m), (m - q) // q))


class Index:
    """q-gram index of a block of items [(item_id, text)]."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, rate: float = RATE):
        self.q = q
        self.ids = [i for i, _ in items]
        self.codes = [codes(t) for _, t in items]
        self.m = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.e = np.array([budget(int(m), q, rate) for m in self.m], dtype=np.int64)
        self.need = np.maximum(1, self.m + 1 - q - q * self.e)
        per = [grams(c, q) for c in self.codes]
        g = np.concatenate(per) if per else np.empty(0, dtype=np.uint64)
        item = np.repeat(np.arange(len(per)), [len(p) for p in per])
        pos = np.concatenate([np.arange(len(p)) for p in per]) if per else item
        order = np.argsort(g, kind="stable")
        self.item, self.pos = item[order], pos[order].astype(np.int64)
        self.step = self.e[self.item] + 1
        self.grams, self.start = np.unique(g[order], return_index=True)
        self.count = np.diff(np.append(self.start, len(g)))
        self.mask = np.zeros(1 << MASK_BITS, dtype=bool)
        self.mask[(self.grams >> np.uint64(64 - MASK_BITS)).astype(np.int64)] = True
        self.least = int(self.need.min()) if len(items) else 1
        self.gap = int(self.e.max(initial=0)) + q + 1  # between two texts: no alignment within a budget crosses it
        # Items shorter than q have no q-gram: they are sought as they are.
        self.short = [k for k, m in enumerate(self.m) if 0 < m < q]

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, start, end, edits) of the matches, by place in the lists.

        The texts are searched as one array, with gaps that no alignment within
        a budget can cross. Neighbouring bands report the same place: the fewest edits win.
        """
        gap = self.gap
        x = codes(("\0" * gap).join(texts)).copy()
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        begin = np.concatenate([[0], np.cumsum(lengths[:-1] + gap)]).astype(np.int64)
        for b, n in zip(begin[:-1], lengths[:-1]):
            x[b + n : b + n + gap] = GAP
        found = []
        for k in self.short:
            found += _exact(x, self.codes[k], k)
        bands = []
        for k, b in self._bands(x):
            step = int(self.e[k]) + 1
            bands.append((k, b * step, (b + 2) * step - 1))
        found += align(self.codes, self.e, x, bands)
        best: dict[tuple[int, int, int], tuple[int, int]] = {}
        for k, start, end, edits in found:
            t = int(np.searchsorted(begin, start, side="right")) - 1
            place, match = (t, k, start - int(begin[t])), (edits, min(end - int(begin[t]), int(lengths[t])))
            best[place] = min(match, best.get(place, match))
        return [(t, k, start, end, edits) for (t, k, start), (edits, end) in best.items()]

    def _bands(self, x: np.ndarray) -> list[tuple[int, int]]:
        """(item, band) with as many common q-grams as the lemma asks for."""
        g = grams(x, self.q)
        if not len(self.grams) or not len(g):
            return []
        at = np.flatnonzero(self.mask[g >> np.uint64(64 - MASK_BITS)])
        where = np.searchsorted(self.grams, g[at])
        where[where == len(self.grams)] = 0
        true = self.grams[where] == g[at]
        at, where = at[true], where[true]
        if len(at) < self.least:
            return []
        n = self.count[where]
        longest = int(self.m.max(initial=0))
        low, width = -longest - 2, len(x) + longest + 4  # of any band number
        keys, counts = [], []
        cuts = np.searchsorted(np.cumsum(n), np.arange(SLICE, int(n.sum()) + SLICE, SLICE), side="left") + 1
        for begin, end in zip(np.concatenate([[0], cuts[:-1]]), cuts):
            if begin >= end:
                continue
            c = n[begin:end]
            entry = np.repeat(self.start[where[begin:end]] - np.concatenate([[0], np.cumsum(c)[:-1]]), c) + np.arange(c.sum())
            diagonal = np.repeat(at[begin:end], c) - self.pos[entry]
            band = diagonal // self.step[entry]  # bands band-1 and band hold this diagonal
            k, h = np.unique(self.item[entry] * width + band - low, return_counts=True)
            keys.append(k)
            counts.append(h)
        key, place = np.unique(np.concatenate(keys), return_inverse=True)
        hits = np.bincount(place, weights=np.concatenate(counts), minlength=len(key)).astype(np.int64)
        # half bands k and k+1 make the overlapping band k
        after = np.zeros_like(hits)
        after[:-1] = np.where(key[1:] == key[:-1] + 1, hits[1:], 0)
        before = np.ones(len(key), dtype=bool)
        before[1:] = key[1:] != key[:-1] + 1
        whole = hits + after >= self.need[key // width]
        alone = before & (hits >= self.need[key // width])  # band k-1, whose first half is empty
        key = np.concatenate([key[whole], key[alone] - 1])
        return list(zip((key // width).tolist(), (key % width + low).tolist()))


def _exact(x: np.ndarray, p: np.ndarray, k: int) -> list[tuple[int, int, int, int]]:
    if len(x) < len(p):
        return []
    same = np.ones(len(x) - len(p) + 1, dtype=bool)
    for j, c in enumerate(p):
        same &= x[j : len(same) + j] == c
    return [(k, int(s), int(s) + len(p), 0) for s in np.flatnonzero(same)]


def _exact_in(p: np.ndarray, x: np.ndarray, low: int, high: int) -> int:
    """First place of p in x from low to high, or -1."""
    for s in range(max(0, low), min(len(x) - len(p), high) + 1):
        if x[s] == p[0] and np.array_equal(x[s : s + len(p)], p):
            return s
    return -1


def _distances(p: list[np.ndarray], x: np.ndarray, low: np.ndarray, width: np.ndarray, e: np.ndarray,
               free: bool) -> list[tuple[int, int]]:
    """For each pattern: (least edit distance of all of it to a part of x, band
    cell where that part ends), over the diagonals low .. low + width - 1.

    All bands advance together, one pattern character a step. The part starts on
    any diagonal of the band (``free``) or on diagonal 0 only. A place outside
    of x equals no character: it costs an edit, like leaving the character out.
    Bands with no cell within their budget e are given up (distance e + 1).
    """
    m = np.array([len(q) for q in p])
    w, longest = int(width.max()), int(m.max())
    pattern = np.full((len(p), longest), GAP - 1, dtype=np.uint32)
    for i, q in enumerate(p):
        pattern[i, : len(q)] = q
    at = low[:, None] + np.arange(w + longest)
    text = np.where((at >= 0) & (at < len(x)), x[np.clip(at, 0, len(x) - 1)], np.uint32(GAP))
    index = np.arange(w, dtype=np.int32)
    far = np.int32(1 << 20)
    out = np.where(index[None, :] >= width[:, None], far, np.int32(0)).astype(np.int32)
    row = out.copy() if free else np.maximum(out, np.abs(low[:, None] + index).astype(np.int32))
    if not free:
        row[low[:, None] + index < 0] = far
    live, result = np.arange(len(p)), [(int(b) + 1, 0) for b in e]
    for i in range(longest):
        new = row + (text[:, i : i + w] != pattern[:, i : i + 1])
        np.minimum(new[:, :-1], row[:, 1:] + 1, out=new[:, :-1])
        new -= index
        np.minimum.accumulate(new, axis=1, out=new)
        new += index
        row = np.maximum(new, out)
        done = m == i + 1
        if done.any():
            for c in np.flatnonzero(done):
                k = int(np.argmin(row[c]))
                if row[c, k] <= e[live[c]]:
                    result[live[c]] = (int(row[c, k]), k)
        if done.any() or i % 16 == 15:
            keep = ~done & (row.min(axis=1) <= e[live])
            if not keep.any():
                break
            if not keep.all():
                row, text, pattern, out, m, live = (v[keep] for v in (row, text, pattern, out, m, live))
    return result


def align(items: list[np.ndarray], budgets: np.ndarray, x: np.ndarray,
          bands: list[tuple[int, int, int]], batch: int = 256) -> list[tuple[int, int, int, int]]:
    """(item, start, end, edits) of the best alignment of the whole item to a part
    of x in each band (item, low, high); bands above the item's budget give none."""
    out, rest = [], []
    for k, low, high in bands:
        s = _exact_in(items[k], x, low, high)
        if s >= 0:
            out.append((k, s, s + len(items[k]), 0))
        elif budgets[k] > 0:
            rest.append((k, low, high))
    rest.sort(key=lambda b: len(items[b[0]]))
    for c in range(0, len(rest), batch):
        part = rest[c : c + batch]
        low = np.array([b for _, b, _ in part])
        width = np.array([b for _, _, b in part]) - low + 1
        e = np.array([budgets[k] for k, _, _ in part])
        for (k, lo, _), best, (d, cell) in zip(part, e, _distances([items[k] for k, _, _ in part], x, low, width, e, True)):
            if d > best:
                continue
            end = min(lo + cell + len(items[k]), len(x))
            # The same backwards from the end gives the start.
            back = x[max(0, end - len(items[k]) - int(best)) : end][::-1]
            (d2, cell2), = _distances([items[k][::-1]], back, np.array([-int(best)]), np.array([2 * int(best) + 1]),
                                      np.array([best]), False)
            length = cell2 - int(best) + len(items[k]) if d2 <= best else len(items[k])
            out.append((k, max(0, end - length), end, d))
    return out


def _chunks(ids_of, texts_of, gap: int) -> Iterator[tuple[list, list[str]]]:
    ids, texts, size = [], [], 0
    for doc, text in zip(ids_of, texts_of):
        if text:
            ids.append(doc)
            texts.append(text)
            size += len(text) + gap
            if size >= CHUNK:
                yield ids, texts
                ids, texts, size = [], [], 0
    if texts:
        yield ids, texts


def _matcher(items: list[tuple[int, str]], q: int, rate: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(items, q, rate)
        for pdf in batches:
            rows = []
            for ids, texts in _chunks(pdf["doc_id"], pdf["text"], index.gap):
                rows += [(ids[t], index.ids[k], start, end, edits) for t, k, start, end, edits in index.search(texts)]
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "start", "end", "edits"])

    return run


def _holder(items: list[tuple[int, str]], q: int, rate: float):
    """A pandas UDF text -> does it hold one of the items?"""

    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(items, q, rate)
        for texts in batches:
            out = np.zeros(len(texts), dtype=bool)
            for places, some in _chunks(range(len(texts)), texts, index.gap):
                for t, *_ in index.search(some):
                    out[places[t]] = True
            yield pd.Series(out)

    return F.pandas_udf(holds, "boolean")


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items with a text, in blocks of about ``block_chars`` characters; one block is held at a time."""
    block, size = [], 0
    for r in benchmark.select("item_id", "text").filter("text is not null and text <> ''").toLocalIterator():
        if block and size + len(r["text"]) > block_chars:
            yield block
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += len(r["text"])
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, start, end, edits): benchmark items found in the texts.

    One row per item and place. Null and empty texts and items match nothing;
    rows of equal or null doc_id are searched each. Other columns play no part. The benchmark is the
    stated query set: it is read in blocks of bounded size, each a pass over the
    documents whose result is stored before the next block is read (a single block's is not).
    Without items or documents there are no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    schema = "doc_id long, item_id long, start long, end long, edits long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = last = None
    for block in item_blocks(benchmark, block_chars):
        if last is not None:
            last = stage(last, "leaks")
            out = last if out is None else out.unionByName(last)
        last = rows.mapInPandas(_matcher(block, q, rate), schema)
    if last is None:
        return spark.createDataFrame([], schema)
    return last if out is None else out.unionByName(last)


def drop_leaking(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE,
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; all columns stay.

    Each row is judged by its own text: rows with a null doc_id go like others, and of several rows
    of one doc_id only those that hold an item. Null and empty texts stay. Each block of
    items is a filter; after ``PASSES`` of them the rows left are stored.
    """
    small_batches(docs.sparkSession)
    kept = docs
    for k, block in enumerate(item_blocks(benchmark, block_chars)):
        if k and k % PASSES == 0:
            kept = stage(kept, "not-leaking")
        kept = kept.filter(~_holder(block, q, rate)(F.col("text")))
    return kept
