"""Evaluation passages inside training text.

Test items are short and documents may be very long, so both are cut into pieces of up to
``PIECE`` word shingles.  The pieces are partitioned by size, and each partition uses as many
minimum hashes as a containment of ``CONTAINMENT`` needs to be met almost surely.  Documents
are read once: a bit table of the items' hash values, of bounded size whatever the number of
items, says which parts of a document are worth a join.  Parts and items meet by an
equi-join on (hash number, value), are verified by the exact containment of shingles, and
what passes is measured by the alignment of its words, which allows for words that were
changed, added or dropped.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.session import cut_lineage

SHINGLE = 5
#: Shingles in a piece; pieces of a document overlap by half, those of an item begin at every other word.
PIECE = 16
CONTAINMENT = 0.25
MISS = 1e-4
#: Pieces of items are searched by the shingles that so many different items have at most, or by
#: their ``LEAST_OWN`` rarest where those are fewer.
OWN = 1
LEAST_OWN = 6
#: A word or shingle in more different items than this is no evidence of one of them.
COMMON = 3
#: Hash values that a part of a document and an item must share: each of the ``CONTAINED`` shingles
#: below is expected to give four.
LEAST_HITS = 6
#: Words in a part of a document that is joined, and how far the next part begins.
PART, ADVANCE = 384, 256
#: A leak repeats so many words of the item.
PASSAGE = 25
#: Shingles of a passage that remain if one word in ten of it was changed.
CONTAINED = 6
#: So many shingles that no other item has tell an altered passage, and so many two passages, from
#: sentences of the same style.
UNIQUE, UNIQUE_OF_TWO = 8, 12
#: Bits of the table of hash values: 128 for each value, at most 2 ** 27 (16 MB).
FILTER_BITS = 27

_SKIP = np.uint32(0xFFFFFFFF)
_TABLE = 0x3000
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))


# --- words and shingles -----------------------------------------------------------------------


def _fold(code: int) -> int:
    """The lower case letter or digit of a code point without accents, 0 for other signs, ``_SKIP``
    for combining marks."""
    char = chr(code).lower()
    if unicodedata.category(char[0]) == "Mn":
        return int(_SKIP)
    bare = [c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn"]
    letter = bare[0] if len(bare) == 1 else char[0]
    return ord(letter) if letter.isalnum() else 0


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    return np.array([_fold(k) for k in range(_TABLE)], np.uint32)


@lru_cache(maxsize=20_000)
def _folded_high(code: int) -> int:
    return 0 if 0xD800 <= code < 0xE000 else _fold(code)


class _Powers:
    """Powers of the multiplier of word hashes and of its inverse, as far as texts need them."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def reach(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << (n - 1).bit_length()
            one = np.ones(1, np.uint64)
            cls.up = np.cumprod(np.concatenate([one, np.full(size - 1, _P)]), dtype=np.uint64)
            cls.down = np.cumprod(np.concatenate([one, np.full(size - 1, _P_INVERSE)]), dtype=np.uint64)
        return cls.up, cls.down


def hash_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the lower case words without accents and punctuation of all texts in a row, and
    the place of each text's first word, followed by the number of all."""
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    bounds = np.concatenate([[0], np.cumsum(lengths)])[:-1] if len(texts) else np.zeros(0, np.int64)
    high = codes >= _TABLE
    letters = _folded()[np.where(high, 0, codes)]
    if high.any():
        kinds, which = np.unique(codes[high], return_inverse=True)
        letters[high] = np.array([_folded_high(int(k)) for k in kinds], np.uint32)[which]
    keep = letters != _SKIP
    if not keep.all():
        before = np.concatenate([[0], np.cumsum(keep)])
        letters, bounds = letters[keep], before[bounds]
    inside = np.concatenate([[False], letters > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _Powers.reach(len(letters) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters * up[: len(letters)], dtype=np.uint64)])
    h = (total[ends] - total[starts]) * down[starts]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(32)).astype(np.uint32), np.concatenate([np.searchsorted(starts, bounds), [len(starts)]])


_RNG = np.random.default_rng(11)
_MIX = _RNG.integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)


def shingles_of(h: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs of ``SHINGLE`` words."""
    n = len(h) - SHINGLE + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    wide, out = h.astype(np.uint64), np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        out += wide[k : k + n] * _MIX[k]
    return out ^ (out >> np.uint64(31))


# --- sketches ---------------------------------------------------------------------------------


def hashes_needed(size: int, query: int = PIECE) -> int:
    """Minimum hashes for pieces of up to ``size`` shingles: the containment of a query piece
    implies a Jaccard value, and that a number of tries until one agrees but for ``MISS``."""
    jaccard = CONTAINMENT * query / (query + size - CONTAINMENT * query)
    return math.ceil(math.log(MISS) / math.log(1 - jaccard))


#: Upper size of each partition of pieces and the hashes it uses.
PARTITIONS = [(size, hashes_needed(size)) for size in (PIECE // 4, PIECE // 2, PIECE)]
HASHES = PARTITIONS[-1][1]
_A = _RNG.integers(1, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)


def hashes_of(sizes: np.ndarray) -> np.ndarray:
    """How many hashes the partition of each piece uses."""
    out = np.full(len(sizes), HASHES)
    for size, n in reversed(PARTITIONS[:-1]):
        out[sizes <= size] = n
    return out


def item_keys(s: np.ndarray, shared: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Keys ``hash number << 32 | value`` of the pieces of an item.  ``shared`` are the shingles that
    other items have too, in order, and ``df`` the number of items that have them."""
    if not len(s):
        return np.zeros(0, np.int64)
    rank = np.ones(len(s), np.int64)
    if len(shared):
        at = np.minimum(np.searchsorted(shared, s), len(shared) - 1)
        rank[shared[at] == s] = df[at][shared[at] == s]
    short = s.astype(np.uint32)
    found = []
    for at in range(0, max(1, len(s) - PIECE + 2), 2):
        piece, often = short[at : at + PIECE], rank[at : at + PIECE]
        # Its own shingles, or the rarest where it has few of them.
        most = max(OWN, np.sort(often)[: min(LEAST_OWN, len(piece))][-1])
        found.append((piece[often <= most][None, :] * _A[:, None]).min(1))
    values = np.array(found, np.uint32).astype(np.int64)
    return np.unique(values | (np.arange(HASHES, dtype=np.int64) << 32)[None, :])


class BitTable:
    """Two bits for each key of the items, in ``2 ** bits`` bits.  A key that is in the table may be
    none of the items': the join decides."""

    def __init__(self, bits: int, packed: np.ndarray) -> None:
        self.bits, self.packed = bits, packed

    @staticmethod
    def places(value: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        # Under each hash the low bits of a value are others of the shingle.
        return value & np.uint32((1 << bits) - 1), (value * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)

    def has(self, value: np.ndarray) -> np.ndarray:
        """The places in ``value`` of what may be the value of an item."""
        first = value & np.uint32((1 << self.bits) - 1)
        hit = np.flatnonzero(self.packed[first >> 3] & _BIT[first & 7])
        second = self.places(value[hit], self.bits)[1]
        return hit[(self.packed[second >> 3] & _BIT[second & 7]) > 0]


_BIT = np.uint8(1) << np.arange(8, dtype=np.uint8)


def bit_table(keys: DataFrame, n_keys: int) -> BitTable:
    """The table of ``keys``; the executors set the bits, the driver receives at most
    ``2 ** FILTER_BITS`` of them as words of 64, whatever the number of keys."""
    bits = min(FILTER_BITS, max(10, math.ceil(math.log2(128 * max(1, n_keys)))))

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            value = (b["key"].to_numpy(np.int64) & 0xFFFFFFFF).astype(np.uint32)
            at = np.unique(np.concatenate(BitTable.places(value, bits))).astype(np.int64)
            yield pd.DataFrame({"word": at >> 6, "bit": np.int64(1) << (at & 63)})

    words = keys.select("key").mapInPandas(places, "word bigint, bit bigint")
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    packed = np.zeros(max(1, 1 << (bits - 6)), np.int64)
    packed[words["word"].to_numpy()] = words["bits"].to_numpy()
    return BitTable(bits, packed.view(np.uint8))


#: Pieces whose hashes are computed together, so that they stay in the processor's cache.
_TOGETHER = 4096


def part_hits(h: np.ndarray, bounds: np.ndarray, table: BitTable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts in a row the pieces with a hash value that the table has: the text, the first word
    of the piece within it and the key of each hit."""
    half = PIECE // 2
    words = np.diff(bounds)
    n = np.maximum(words - SHINGLE + 1, 0)
    s = shingles_of(h).astype(np.uint32)
    blocks = -(-n // half)
    owner = np.repeat(np.arange(len(n)), blocks)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    # The last block of a text is filled with its last shingle.
    at = bounds[owner] + half * within
    last = bounds[owner] + n[owner] - 1
    joined = np.append(owner[:-1] == owner[1:], False) if len(owner) else np.zeros(0, bool)
    # The last block of a longer text is part of the piece before it.
    alone = (within == blocks[owner] - 1) & (within > 0)
    needed = hashes_of(n)[owner]
    texts, firsts, keys = [], [], []
    for lo in range(0, len(owner), _TOGETHER):
        hi = min(len(owner), lo + _TOGETHER + 1)
        grid = s[np.minimum(at[lo:hi][None, :] + np.arange(half)[:, None], last[lo:hi][None, :])]
        end = min(hi - lo, _TOGETHER)
        pair, skip, most = joined[lo : lo + end], alone[lo : lo + end], needed[lo : lo + end]
        for k in range(int(most.max())):
            minima = (grid * _A[k]).min(0)
            value = minima[:end].copy()
            follow = np.append(minima[1:], minima[-1:])[:end]
            np.minimum(value, follow, out=value, where=pair)
            hit = table.has(value)
            hit = hit[~skip[hit] & (most[hit] > k)]
            if len(hit):
                texts.append(owner[lo + hit])
                firsts.append(half * within[lo + hit])
                keys.append(value[hit].astype(np.int64) | (k << 32))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(texts), np.concatenate(firsts), np.concatenate(keys)


#: Words around an item's own shingles that are aligned, and places of alignments computed together.
_MARGIN, _CELLS = PASSAGE, 4_000_000
_GAP = 3

# --- verification -----------------------------------------------------------------------------


class Item:
    """What the verification needs of one item."""

    def __init__(self, words: bytes, shared: bytes, df: bytes, common_words: bytes) -> None:
        self.words = np.frombuffer(words, np.uint32)
        self.shingles = shingles_of(self.words)
        self.all = np.unique(self.shingles)
        tokens = np.frombuffer(shared, np.uint64)
        self.own = np.setdiff1d(self.all, tokens[np.frombuffer(df, np.int64) > COMMON], assume_unique=True)
        self.unique = np.setdiff1d(self.all, tokens, assume_unique=True)
        self.rare = ~np.isin(self.words, np.frombuffer(common_words, np.uint32))


def _within(s: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    """Which values are in a sorted set."""
    if not len(sorted_set):
        return np.zeros(len(s), bool)
    at = np.searchsorted(sorted_set, s)
    return sorted_set[np.minimum(at, len(sorted_set) - 1)] == s


def regions_of(parts: list[np.ndarray], item: Item) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """What parts of documents have of one item, one value for each part: words in a passage that is
    repeated unchanged, the share of the item's own shingles, how many of them the best two
    diagonals have, ``[part, 2]``; and the regions, as (part, words), that may be altered passages."""
    sizes = np.array([len(x) for x in parts])
    ends = np.cumsum(sizes)
    h, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), sizes)
    s = shingles_of(h)
    same, share, two, regions = np.zeros(len(parts), np.int64), np.zeros(len(parts)), np.zeros((len(parts), 2), np.int64), []
    if not len(s):
        return same, share, two, regions
    inside = owner[: len(s)] == owner[SHINGLE - 1 :]
    order = np.argsort(item.shingles, kind="stable")
    in_order = item.shingles[order]
    at = np.minimum(np.searchsorted(in_order, s), len(order) - 1)
    met = (in_order[at] == s) & inside

    # Words repeated one after the other.
    edges = np.flatnonzero(np.diff(np.concatenate([[False], met, [False]]).astype(np.int8)))
    for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if hi - lo >= min(PASSAGE, len(item.words)) - SHINGLE + 1:
            run = verbatim(h[lo : hi + SHINGLE - 1], item.words)
            same[owner[lo]] = max(same[owner[lo]], run if run >= PASSAGE else 0)

    # The exact containment: an altered passage leaves many of the item's own shingles in their order,
    # that is near one diagonal of places in the part and in the item.
    own = np.flatnonzero(met & _within(s, item.own if len(item.own) else item.all))
    part = owner[own]
    known = np.unique(np.stack([part, at[own]]), axis=1)[0] if len(own) else part
    share = np.bincount(known, minlength=len(parts)) / max(1, len(item.own))
    place = own - (ends - sizes)[part]
    diagonal = place - order[at[own]]
    by = np.lexsort((diagonal, part))
    part, place, diagonal = part[by], place[by], diagonal[by]
    start = np.append(True, (np.diff(part) != 0) | (np.diff(diagonal) > 4)) if len(by) else np.zeros(0, bool)
    cluster = np.cumsum(start) - 1
    counts, of = np.bincount(cluster), part[start]
    ranked = np.lexsort((-counts, of))
    top = np.append(True, np.diff(of[ranked]) != 0) if len(of) else np.zeros(0, bool)
    two[of[ranked][top], 0] = counts[ranked][top]
    follows = np.append(False, top[:-1]) & ~top if len(of) else top
    two[of[ranked][follows], 1] = counts[ranked][follows]
    kept = (counts > 1)[cluster] | (len(item.own) < 2)
    part, place = part[kept], place[kept]
    by = np.lexsort((place, part))
    part, place = part[by], place[by]
    cuts = np.flatnonzero((np.diff(part) != 0) | (np.diff(place) > 2 * _MARGIN)) + 1
    lows, highs = np.append(0, cuts), np.append(cuts, len(part)) - 1
    if len(part):
        for k, lo, hi in zip(part[lows].tolist(), place[lows].tolist(), place[highs].tolist(), strict=True):
            regions.append((k, parts[k][max(0, lo - _MARGIN) : hi + SHINGLE + _MARGIN].copy()))
    return same, share, two, regions


def all_passages(regions: list[list[np.ndarray]], items: list[Item]) -> list[list[tuple[int, int, int, int, int, int]]]:
    """For each item and the regions of one document its passages there: score, words in common, rare
    words and unique shingles among them, first and last word in the item."""
    out: list[list[tuple]] = [[] for _ in regions]
    todo = [(k, r.copy()) for k, rs in enumerate(regions) for r in rs]
    for _ in range(2):
        again = []
        aligned = align_all([r for _, r in todo], [items[k] for k, _ in todo])
        for (k, region), (score, matched, n_rare, span, item_span) in zip(todo, aligned, strict=True):
            item = items[k]
            if score >= 8 * min(1.0, len(item.words) / PASSAGE):
                n_unique = int(_within(np.unique(shingles_of(region[span[0] : span[1]])), item.unique).sum())
                out[k].append((score, matched, n_rare, n_unique, *item_span))
                region[span[0] : span[1]] = 0
                again.append((k, region))
        todo = again
    return out


def verbatim(a: np.ndarray, b: np.ndarray) -> int:
    """Words of the longest part of ``b`` that ``a`` repeats unchanged."""
    most, run = 0, np.zeros(len(b) + 1, int)
    for x in a:
        run[1:] = np.where(b == x, run[:-1] + 1, 0)
        most = max(most, int(run.max()))
    return most


def align_all(regions: list[np.ndarray], items: list[Item]) -> list[tuple[int, int, int, tuple[int, int], tuple[int, int]]]:
    """The best local alignment of each region with its item, regions of like length together."""
    out: list = [(0, 0, 0, (0, 0), (0, 0))] * len(regions)
    order = sorted(range(len(regions)), key=lambda k: len(regions[k]))
    lo = 0
    while lo < len(order):
        hi, wide = lo, 1
        while hi < len(order) and hi - lo < 256:
            wide = max(wide, len(items[order[hi]].words) + 1)
            if hi > lo and (len(regions[order[hi]]) + 1) * wide * (hi - lo + 1) > _CELLS:
                break
            hi += 1
        some = order[lo:hi]
        for k, found in zip(some, _align([regions[k] for k in some], [items[k].words for k in some], [items[k].rare for k in some]), strict=True):
            out[k] = found
        lo = hi
    return out


def _align(a: list[np.ndarray], b: list[np.ndarray], rare: list[np.ndarray]) -> list[tuple[int, int, int, tuple[int, int], tuple[int, int]]]:
    """Best local alignments: a word in common counts 1, a changed, added or dropped one -2.

    Gives the score, the words in common, how many of them are rare, and both spans."""
    long, wide = max(map(len, a)), max(map(len, b))
    # Filled places agree with nothing.
    left, right = np.zeros((long, len(a), 1), np.uint32), np.full((len(b), wide), 1, np.uint32)
    for k, (x, y) in enumerate(zip(a, b, strict=True)):
        left[: len(x), k, 0] = x
        right[k, : len(y)] = y
    rows = np.zeros((long + 1, len(a), wide + 1), np.int16)
    step, gain = np.empty((len(a), wide), np.int16), np.empty((len(a), wide), bool)
    for i in range(long):
        before, now = rows[i], rows[i + 1]
        np.equal(right, left[i], out=gain)
        np.multiply(gain, np.int16(3), out=step)
        step += before[:, :-1]
        step -= 2
        np.subtract(before, 2, out=now)
        np.maximum(now, 0, out=now)
        np.maximum(now[:, 1:], step, out=now[:, 1:])
        # Up to so many words of the item in a row may be missing.
        for _ in range(_GAP):
            np.subtract(now[:, :-1], 2, out=step)
            np.maximum(now[:, 1:], step, out=now[:, 1:])
    best = rows.transpose(1, 0, 2).reshape(len(a), -1).argmax(1)
    return [_trace(rows[:, k], a[k], b[k], rare[k], *divmod(int(best[k]), wide + 1)) for k in range(len(a))]


def _trace(rows: np.ndarray, a: np.ndarray, b: np.ndarray, rare: np.ndarray, i: int, j: int) -> tuple:
    score, end, end_b, matched, n_rare = int(rows[i, j]), i, j, 0, 0
    here = score
    while i > 0 and j > 0 and here > 0:
        same = a[i - 1] == b[j - 1]
        diagonal = int(rows[i - 1, j - 1])
        if here - diagonal == (1 if same else -2):
            matched += int(same)
            n_rare += int(same and rare[j - 1])
            i, j, here = i - 1, j - 1, diagonal
        elif here == int(rows[i - 1, j]) - 2:
            i, here = i - 1, int(rows[i - 1, j])
        else:
            j, here = j - 1, int(rows[i, j - 1])
    return score, matched, n_rare, (i, end), (j, end_b)


def leaked_words(passages: list[tuple[int, ...]], n_words: int, n_rare_words: int) -> int:
    """Words of an item of ``n_words`` that altered passages of one document repeat, in one of them or
    in two that are different parts of the item; 0 if they are no leak."""
    scale, most = min(1.0, n_words / PASSAGE), 0
    # Passages with words of the item's own go before common phrases that align as well.
    alone = [[p] for p in passages]
    for kept in (passages, [p for p in passages if p[2]], [p for p in passages if p[3]], *alone):
        best = sorted(kept, key=lambda p: (-p[0], *p[1:]))
        if best:
            seen = best[0][4:6]
            best = best[:1] + [p for p in best[1:] if min(seen[1], p[5]) - max(seen[0], p[4]) <= 3][:1]
        score, matched, n_rare, n_unique = (sum(p[k] for p in best) for k in range(4))
        enough = (score >= 22 * scale and n_rare >= min(2, n_rare_words)) or (score >= 16 * scale and n_rare >= 3)
        enough |= score >= 16 * scale and matched >= (PASSAGE - 3) * scale and n_unique >= (UNIQUE if len(best) == 1 else UNIQUE_OF_TWO)
        most = max(most, int(matched) if enough else 0)
    return most


# --- the search -------------------------------------------------------------------------------


def _hashed(texts: pd.Series, chars: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``chars`` characters: the first, the words and the bounds of each."""
    lengths = texts.str.len().to_numpy()
    values = texts.tolist()
    lo, size = 0, 0
    for k, n in enumerate(lengths):
        size += int(n)
        if size >= chars or k + 1 == len(values):
            h, bounds = hash_words(values[lo : k + 1])
            yield lo, h, bounds
            lo, size = k + 1, 0


def item_table(items: DataFrame, item_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The texts of the items ``(text_id, words, shared, df, common_words)``, once each, and
    ``(text_id, item_id)``.  What is shared is counted over all items."""
    asked = items.select(F.col(item_id).alias("__item"), F.col(text).alias("__text")).where("__item is not null and length(__text) > 0")
    kind = dict(items.dtypes)[item_id]

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo, h, bounds in _hashed(b["__text"]):
                own = [h[bounds[k] : bounds[k + 1]] for k in range(len(bounds) - 1)]
                yield pd.DataFrame({"__item": b["__item"].iloc[lo : lo + len(own)].to_numpy(), "words": [w.tobytes() for w in own]})

    hashed = asked.mapInPandas(words, f"__item {kind}, words binary").where("length(words) > 0")
    hashed = cut_lineage(hashed.withColumn("text_id", F.xxhash64("words")))
    texts = hashed.select("text_id", "words").dropDuplicates(["text_id"])

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, w in zip(b["text_id"], b["words"], strict=True):
                h = np.frombuffer(w, np.uint32)
                found = [np.unique(h).astype(np.int64), np.unique(shingles_of(h)).view(np.int64)]
                kinds = np.repeat([0, 1], [len(x) for x in found])
                out.append(pd.DataFrame({"text_id": i, "is_shingle": kinds == 1, "token": np.concatenate(found)}))
            if out:
                yield pd.concat(out, ignore_index=True)

    rows = cut_lineage(texts.mapInPandas(tokens, "text_id bigint, is_shingle boolean, token bigint"))
    counts = rows.groupBy("is_shingle", "token").agg(F.count("*").alias("df")).where(F.col("df") > OWN)
    often = rows.join(counts, ["is_shingle", "token"]).groupBy("text_id").agg(
        F.collect_list(F.when(F.col("is_shingle"), F.struct("token", "df"))).alias("shared"),
        F.collect_list(F.when(~F.col("is_shingle") & (F.col("df") > COMMON), F.col("token"))).alias("common_words"),
    )
    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, w, shared, common in zip(b["text_id"], b["words"], b["shared"], b["common_words"], strict=True):
                shared, common = ([] if x is None else x for x in (shared, common))
                tokens = np.array([r["token"] for r in shared], np.int64).view(np.uint64)
                order = np.argsort(tokens)
                df = np.array([r["df"] for r in shared], np.int64)
                rows.append((i, w, tokens[order].tobytes(), df[order].tobytes(), np.array(common, np.int64).astype(np.uint32).tobytes()))
            yield pd.DataFrame(rows, columns=["text_id", "words", "shared", "df", "common_words"])

    facts = texts.join(often, "text_id", "left").mapInPandas(packed, "text_id bigint, words binary, shared binary, df binary, common_words binary")
    return cut_lineage(facts), hashed.select("text_id", F.col("__item").alias(item_id))


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Rows ``(doc_id, item_id, n_words, containment)``, one per document and leaked item.

    * Null and empty texts, and items shorter than a shingle, give no row.
    * Whole documents are searched, however long; repeated documents each give their rows.
    * Items with the same text are all reported.  Empty tables give an empty result; other
      columns are not read.

    ``n_words`` are the words of the item that one passage or two of the document repeat,
    ``containment`` is the largest share of its own shingles in a part of the document.
    The documents are read once and not shuffled; what is joined are the parts of them that
    have a hash value of some item.
    """
    kinds = dict(docs.dtypes)[doc_id], dict(items.dtypes)[item_id]
    facts, names = item_table(items, item_id, text)

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, w, shared, df in zip(b["text_id"], b["words"], b["shared"], b["df"], strict=True):
                keys = item_keys(shingles_of(np.frombuffer(w, np.uint32)), np.frombuffer(shared, np.uint64), np.frombuffer(df, np.int64))
                out.append({"key": keys, "text_id": i, "need": min(LEAST_HITS, max(1, len(w) // 4 - SHINGLE + 1))})
            if out:
                yield pd.concat([pd.DataFrame(x) for x in out], ignore_index=True)

    keys = cut_lineage(facts.select("text_id", "words", "shared", "df").mapInPandas(sketch, "key bigint, text_id bigint, need int"))
    table = docs.sparkSession.sparkContext.broadcast(bit_table(keys, keys.count()))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo, h, bounds in _hashed(b["__text"]):
                these = slice(lo, lo + len(bounds) - 1)
                found = part_rows(b["__id"].iloc[these].to_numpy(), b["__n"].iloc[these].to_numpy(), h, bounds, table.value)
                if len(found):
                    yield found

    rows = docs.select(F.col(doc_id).alias("__id"), F.monotonically_increasing_id().alias("__n"), F.col(text).alias("__text"))
    rows = rows.where(F.length("__text") > 0)
    parts = rows.mapInPandas(search, f"__id {kinds[0]}, __n bigint, part int, words binary, keys array<bigint>")
    parts = cut_lineage(parts)

    met = parts.select("__n", "part", F.explode("keys").alias("key")).join(keys, "key")
    met = met.groupBy("__n", "part", "text_id").agg(F.count("*").alias("hits"), F.first("need").alias("need"))
    met = met.where("hits >= need").select("__n", "part", "text_id")
    facts = facts.withColumnRenamed("words", "item_words")
    # The steps in Python cost more than their bytes tell, so they are not merged into few tasks; the
    # pairs are spread before the words of the parts are joined to them, so each part moves once.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = met.repartition(tasks, "__n", "part").join(parts.drop("keys"), ["__n", "part"]).join(facts, "text_id")

    def items_in(b: pd.DataFrame) -> dict[int, Item]:
        some = b.drop_duplicates("text_id")
        return {i: Item(*x) for i, *x in zip(*(some[c] for c in ("text_id", "item_words", "shared", "df", "common_words")), strict=True)}

    def contain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            items_of, out = items_in(b), []
            for text_id, rows in b.groupby("text_id", sort=False):
                item = items_of[text_id]
                same, share, two, regions = regions_of([np.frombuffer(w, np.uint32) for w in rows["words"]], item)
                kept: list[list[bytes]] = [[] for _ in same]
                for k, region in regions:
                    kept[k].append(region.tobytes())
                need = min(CONTAINED, len(item.own) or len(item.all))
                out.append(pd.DataFrame({
                    "doc": rows["doc"].to_numpy(), "n": rows["n"].to_numpy(), "text_id": text_id, "same": same, "share": share,
                    "best": two[:, 0], "both": two.sum(1), "need": need, "regions": kept,
                })[(same > 0) | (two[:, 0] > 1) | (two.sum(1) >= need)])
            # One frame for each batch: every frame costs a batch of its own on the way back.
            if out:
                yield pd.concat(out, ignore_index=True)

    pairs = pairs.withColumnsRenamed({"__id": "doc", "__n": "n"}).select("doc", "n", "text_id", "words", "item_words", "shared", "df", "common_words")
    parts_with = pairs.mapInPandas(
        contain, f"doc {kinds[0]}, n bigint, text_id bigint, same int, share double, best int, both int, need int, regions array<binary>"
    )
    # An altered leak has the shingles in one passage or in two, which may be in different parts.
    found = parts_with.groupBy("n", "text_id").agg(
        F.first("doc").alias("doc"), F.max("same").alias("same"), F.max("share").alias("containment"), F.max("need").alias("need"),
        F.max("both").alias("both"), F.slice(F.sort_array(F.collect_list("best"), False), 1, 2).alias("best"),
        F.array_distinct(F.flatten(F.collect_list("regions"))).alias("regions"),
    )
    across = F.aggregate("best", F.lit(0), lambda a, x: a + x)
    found = found.where((F.col("same") > 0) | (F.greatest("both", across) >= F.col("need"))).drop("need", "both", "best")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            items_of = items_in(b)
            known = [items_of[i] for i in b["text_id"]]
            found = all_passages([[np.frombuffer(r, np.uint32) for r in rs] for rs in b["regions"]], known)
            words = [leaked_words(p, len(i.words), int(i.rare.sum())) for p, i in zip(found, known, strict=True)]
            n_words = np.maximum(np.array(words, np.int64), b["same"].to_numpy(np.int64))
            out = pd.DataFrame({"__doc": b["doc"], "text_id": b["text_id"], "n_words": n_words, "containment": b["containment"]})
            out = out[out["n_words"] > 0]
            if len(out):
                yield out

    leaks = found.repartition(tasks, "n", "text_id").join(facts, "text_id").mapInPandas(judge, f"__doc {kinds[0]}, text_id bigint, n_words int, containment double")
    return leaks.join(names, "text_id").select(F.col("__doc").alias(doc_id), item_id, "n_words", "containment")


def part_rows(ids: np.ndarray, numbers: np.ndarray, h: np.ndarray, bounds: np.ndarray, table: BitTable) -> pd.DataFrame:
    """The parts of texts in a row that have a hit, with their words and keys."""
    owner, first, key = part_hits(h, bounds, table)
    # A piece lies in one part or in two that overlap.
    part = first // ADVANCE
    before = (part > 0) & (first - (part - 1) * ADVANCE + PIECE + SHINGLE <= PART)
    owner, key = np.concatenate([owner, owner[before]]), np.concatenate([key, key[before]])
    part = np.concatenate([part, part[before] - 1])
    order = np.lexsort((key, part, owner))
    owner, part, key = owner[order], part[order], key[order]
    cuts = np.flatnonzero((np.diff(owner) != 0) | (np.diff(part) != 0)) + 1
    starts = np.concatenate([[0], cuts]) if len(owner) else np.zeros(0, np.int64)
    ends = np.concatenate([cuts, [len(owner)]]) if len(owner) else np.zeros(0, np.int64)
    words = []
    for k in starts.tolist():
        lo = bounds[owner[k]] + part[k] * ADVANCE
        words.append(h[lo : min(lo + PART, bounds[owner[k] + 1])].tobytes())
    return pd.DataFrame({
        "__id": ids[owner[starts]], "__n": numbers[owner[starts]], "part": part[starts].astype("int32"), "words": words,
        "keys": [np.unique(key[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)],
    })
