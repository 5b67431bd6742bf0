"""Documents of varying length placed in containers of fixed capacities.

Variable-capacity best fit: items go, largest first, to the open container they fill best.  If
none has room, a container is opened, of all capacities the one of which the items still to
come would leave the least share unused, and at the end every container is exchanged for the smallest that holds
its contents.  Blocks of documents are packed independently; a block holds so many tokens
that its last containers do not matter.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.session import cut_lineage

TOKENIZERS = "/opt/tokenizers"
TOKENIZER = "byte_bpe_50k.tiktoken"
#: Tokens in a block; ids and lengths of its documents are what one task holds.
BLOCK_TOKENS = 1 << 25


@lru_cache(maxsize=4)
def token_counter(name: str = TOKENIZER, folder: str = TOKENIZERS) -> Callable[[list[str]], list[int]]:
    """A function from texts to their numbers of tokens, special tokens read as plain text."""
    path = f"{folder}/{name}"
    if name.endswith(".tiktoken"):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(own.encode_ordinary(t)) for t in texts]
    if name.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    fast = Tokenizer.from_file(path)
    fast.encode_special_tokens = True
    return lambda texts: [len(x.ids) for x in fast.encode_batch(texts, add_special_tokens=False)]


def count_tokens(df: DataFrame, doc_id: str, text: str, name: str = TOKENIZER, folder: str = TOKENIZERS) -> DataFrame:
    """Rows ``(doc_id, n_tokens)``; a null text has no tokens."""
    kind = dict(df.dtypes)[doc_id]
    rows = df.select(F.col(doc_id).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = token_counter(name, folder)
        for b in batches:
            yield pd.DataFrame({doc_id: b["__id"], "n_tokens": np.array(count(b["__text"].tolist()), "int64")})

    return rows.mapInPandas(run, f"`{doc_id}` {kind}, n_tokens bigint")


def unused_room(room: int, counts: list[int], present: int) -> int:
    """What is left of ``room`` if it takes the largest of the remaining items again and again;
    ``counts`` has the number of items of each size, ``present`` a bit for each size there is."""
    below = present & ((1 << (room + 1)) - 1)
    while below:
        size = below.bit_length() - 1
        if size == 0:
            break
        room -= size * min(counts[size], room // size)
        below &= (1 << min(size, room + 1)) - 1
    return room


def best_fit(sizes: list[int], capacities: list[int]) -> tuple[list[int], list[int]]:
    """Container of each item, and capacity of each container; sizes are at most the largest capacity.

    Open containers are kept by their free room in a bit set, so the best one for an item is
    the lowest set bit from its size on.  A new container has the capacity of which the items
    still to come would leave the least share unused."""
    largest = capacities[-1]
    rooms: list[list[int]] = [[] for _ in range(largest + 1)]
    mask = 0
    place = [0] * len(sizes)
    filled: list[int] = []
    counts, present = [0] * (largest + 1), 0
    for size in sizes:
        counts[size] += 1
        present |= 1 << size
    for k in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[k]
        counts[size] -= 1
        if not counts[size]:
            present &= ~(1 << size)
        at = mask >> size
        if at:
            room = size + (at & -at).bit_length() - 1
            box = rooms[room].pop()
            if not rooms[room]:
                mask &= ~(1 << room)
        else:
            fits = [c for c in capacities if c >= size]
            # Of equal shares the larger capacity, which leaves later items more choice.
            room = min(fits, key=lambda c: (unused_room(c - size, counts, present) / c, -c))
            box = len(filled)
            filled.append(0)
        place[k] = box
        filled[box] += size
        rest = room - size
        rooms[rest].append(box)
        mask |= 1 << rest
    return place, [next(c for c in capacities if c >= n) for n in filled]


def pack_documents(
    counts: DataFrame, containers: list[tuple[str, int]], doc_id: str = "doc_id", block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """Rows ``(doc_id, piece_no, start_token, n_tokens, container_id, container_kind, capacity_tokens)``.

    ``counts`` has ``doc_id, n_tokens``.  Each row is placed exactly once: whole, or, if it
    alone exceeds the largest capacity, in pieces of that capacity and a rest.

    * A document without tokens takes no room and is one piece of 0 tokens.
    * Null ids are documents like others; repeated rows are placed once each.
    * An empty table gives an empty result; no containers are an error.
    """
    if not containers or min(c for _, c in containers) < 1:
        raise ValueError("there must be containers, all with room")
    kinds = {c: k for k, c in sorted(containers, key=lambda x: (x[1], x[0]), reverse=True)}
    capacities = sorted(kinds)
    largest = capacities[-1]
    total = counts.agg(F.sum("n_tokens"), F.count("*")).first()
    blocks = max(1, math.ceil((total[0] or 0) / block_tokens), math.ceil(total[1] / 2_000_000))
    kind = dict(counts.dtypes)[doc_id]

    def pack(keys: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([doc_id, "n_tokens"], kind="stable")
        ids, piece, start, size = [], [], [], []
        for i, n in zip(pdf[doc_id], pdf["n_tokens"], strict=True):
            for k, at in enumerate(range(0, max(1, int(n)), largest)):
                ids.append(i)
                piece.append(k)
                start.append(at)
                size.append(min(largest, int(n) - at))
        place, capacity = best_fit(size, capacities)
        held = [capacity[p] for p in place]
        return pd.DataFrame({
            doc_id: ids, "piece_no": piece, "start_token": start, "n_tokens": size,
            "container_id": [(int(keys[0]) << 32) + p for p in place],
            "container_kind": [kinds[c] for c in held], "capacity_tokens": held,
        })

    schema = (
        f"`{doc_id}` {kind}, piece_no int, start_token bigint, n_tokens bigint, container_id bigint, "
        "container_kind string, capacity_tokens bigint"
    )
    # Rows without an id are spread by their place.
    spread = F.when(F.col(doc_id).isNull(), F.xxhash64(F.monotonically_increasing_id())).otherwise(F.xxhash64(doc_id, "n_tokens", F.lit(3)))
    salted = counts.withColumn("__block", F.pmod(spread, F.lit(blocks)))
    return salted.groupBy("__block").applyInPandas(pack, schema)


def container_list(containers: DataFrame, rows: int = 100) -> list[tuple[str, int]]:
    """The containers; the table is fixed and small, more than ``rows`` rows are an error."""
    found = containers.select("container_kind", "capacity_tokens").limit(rows + 1).collect()
    if len(found) > rows:
        raise ValueError("the table of containers is larger than expected")
    return [(r.container_kind, r.capacity_tokens) for r in found]


def pack_table(df: DataFrame, containers: DataFrame, doc_id: str, text: str, name: str = TOKENIZER, folder: str = TOKENIZERS) -> DataFrame:
    """Documents placed in containers of all capacities together, measured in tokens of ``name``."""
    counts = cut_lineage(count_tokens(df, doc_id, text, name, folder))
    return pack_documents(counts, container_list(containers), doc_id).withColumn("tokenizer", F.lit(name))


def pack_each(df: DataFrame, containers: DataFrame, doc_id: str, text: str, name: str = TOKENIZER, folder: str = TOKENIZERS) -> DataFrame:
    """The same for each capacity by itself: one complete packing per kind of container."""
    counts = cut_lineage(count_tokens(df, doc_id, text, name, folder))
    out = None
    for kind, capacity in sorted(container_list(containers), key=lambda x: x[1]):
        part = pack_documents(counts, [(kind, capacity)], doc_id)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("tokenizer", F.lit(name))
