"""Texts packed into containers of fixed capacity at a set mixture of sources.

Texts are sized in tokens of a public tokenizer whose vocabulary file is a parameter.  A text
larger than a container gives full containers of its own and one remainder; no other text is
split.  Remainders and whole texts go to packing groups by a hash of their key, so that no source
can fill one, and each group is packed by deficit round-robin: every source has a queue, and a
window gives each queue its share of the capacity on top of the deficit it carries.  The queue
that is owed most opens the window with its largest item; the room is filled with the largest
items that fit, of nearly equal ones that of the queue owed most; all are charged to their queues.

The groups of a capacity are numbered, and the difference between what the sources of all groups
before bring and their target is a group's opening deficit, from sums over blocks of groups: so
deficits carry over groups as they do over windows.  The target is the share of each source in all
tokens unless ``targets`` gives another; as nothing may be dropped, a target steers the order in
which sources meet, and the last windows hold what is left.

Defined results: NULL and empty texts have no tokens and are placed in the first container of
their group; NULL sources count as one source; repeated rows of one key are packed once.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern that the public vocabulary was made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Tokens and containers that a packing group holds at most, about.
GROUP_TOKENS, GROUP_CONTAINERS = 4_000_000, 1_000
#: Groups whose deficits one task adds up.
BLOCK = 1_000
#: Kinds of containers, a table of settings.
MAX_KINDS = 1_000
#: Items of at least this share of the largest that fits may go before it, for the mixture.
NEARLY = 0.97
#: The share of a container that follows the deficits before the rest is filled by size, and the tokens that the rest has at least.
BALANCED, CLOSING = 0.75, 2_048

PLACED = "window_name string, container_id string, doc_id bigint, piece_no int, start_token bigint, n_tokens bigint, source string"


@lru_cache(1)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _sizes(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = _encoding(path)
        for batch in batches:
            yield batch[["doc_id", "source"]].assign(n_tokens=[len(encoding.encode_ordinary(t)) if t else 0 for t in batch["text"]])

    return run


def sized(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``documents(doc_id, text, source)`` to ``(doc_id, source, n_tokens)``."""
    texts = documents.where("doc_id is not null").select("doc_id", "text", F.coalesce("source", F.lit("")).alias("source"))
    return texts.mapInPandas(_sizes(vocabulary), "doc_id bigint, source string, n_tokens bigint").dropDuplicates(["doc_id"])


def pack(items: list[tuple[int, int]], sources: list[str], shares: dict[str, float], deficits: dict[str, float], capacity: int) -> list[list[int]]:
    """Containers of positions in ``items`` (size, position): deficit round-robin over the sources."""
    queues: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for item, source in zip(items, sources, strict=True):
        queues[source].append(item)
    for q in queues.values():
        q.sort()
    deficit = defaultdict(float, deficits)
    out = []
    while queues:
        room, window = capacity, []

        def take(source: str, at: int, window: list[int] = window) -> int:
            size, position = queues[source].pop(at)
            window.append(position)
            deficit[source] -= size
            if not queues[source]:
                del queues[source]
            return size

        for source in queues:
            deficit[source] += capacity * shares.get(source, 0.0)
        # the source that is owed most opens the window with its largest item
        opener = max(queues, key=lambda s: (deficit[s], s))
        room -= take(opener, len(queues[opener]) - 1)
        # while there is much room, the queue that is owed most gives the largest item that it is owed
        while room > max((1 - BALANCED) * capacity, CLOSING):
            fits = [(deficit[s], s, at) for s in queues if (at := bisect_right(queues[s], (min(room, max(deficit[s], 0)), 1 << 62)))]
            if not fits:
                break
            _, source, at = max(fits)
            room -= take(source, at - 1)
        while True:  # then what fits best; among nearly equal items, that of the source that is owed most
            fits = [(queues[s][at - 1][0], s, at - 1) for s in queues if (at := bisect_right(queues[s], (room, 1 << 62)))]
            if not fits:
                break
            most = max(size for size, _, _ in fits)
            _, source, at = max((x for x in fits if x[0] >= NEARLY * most), key=lambda x: (deficit[x[1]], x[0], x[1]))
            room -= take(source, at)
        out.append(window)
    return out


def _pack_group(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    name, number = key[0], int(key[1])
    group = group.sort_values(["doc_id"], ignore_index=True)
    first = group.drop_duplicates("source")
    shares = dict(zip(first["source"], first["share"], strict=True))
    deficits = dict(zip(first["source"], first["opening"], strict=True))
    windows = pack(list(zip(group["n_tokens"], range(len(group)), strict=True)), list(group["source"]), shares, deficits, int(group["capacity"].iloc[0]))
    where = {position: k for k, window in enumerate(windows) for position in window}
    ids = [f"{name}-{number:06d}-{where[k]:06d}" for k in range(len(group))]
    return group.assign(container_id=ids)[["window_name", "container_id", "doc_id", "piece_no", "start_token", "n_tokens", "source"]]


def opening_deficits(sums: DataFrame, block: int = BLOCK) -> DataFrame:
    """``sums(window_name, number, source, target, tokens)`` to ``(window_name, number, source, opening)``.

    The opening deficit of a group is what all groups before it lack of their target: sums over
    blocks of groups, and within a block, so that no task walks through all groups of a source.
    Decimals, so that a lost task computes the same sums in whatever order.
    """
    lacks = sums.select("window_name", "number", "source", (F.col("target") - F.col("tokens")).cast("decimal(28,6)").alias("lack"), F.floor(F.col("number") / block).alias("block"))
    blocks = lacks.groupBy("window_name", "source", "block").agg(F.sum("lack").alias("lack"))
    earlier = Window.partitionBy("window_name", "source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("window_name", "source", "block", F.sum("lack").over(earlier).alias("carried"))
    within = Window.partitionBy("window_name", "source", "block").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    part = lacks.withColumn("part", F.sum("lack").over(within)).join(carried, ["window_name", "source", "block"])
    value = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return part.select("window_name", "number", "source", (value("carried") + value("part")).alias("opening"))


def packed(documents: DataFrame, windows: DataFrame, *, targets: DataFrame | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """Every document in containers of every capacity of ``windows(window_name, capacity_tokens)``.

    Columns ``window_name, container_id, doc_id, piece_no, start_token, n_tokens, source``;
    ``targets(source, share)`` sets the mixture.
    """
    sizes = cut_lineage(sized(documents, vocabulary))
    kinds = windows.where("window_name is not null and capacity_tokens > 0").select("window_name", F.col("capacity_tokens").cast("bigint").alias("capacity")).distinct().limit(MAX_KINDS + 1).collect()
    if len(kinds) > MAX_KINDS:
        raise ValueError(f"more than {MAX_KINDS} kinds of containers")
    none = F.expr("cast(array() as array<struct<window_name:string,capacity:bigint>>)")
    kind = F.explode(none if not kinds else F.array(*(F.struct(F.lit(k["window_name"]).alias("window_name"), F.lit(k["capacity"]).cast("bigint").alias("capacity")) for k in kinds))).alias("kind")
    every = sizes.select("doc_id", "source", "n_tokens", kind).select("doc_id", "source", "n_tokens", "kind.window_name", "kind.capacity")
    full = F.floor(F.col("n_tokens") / F.col("capacity")).cast("int")
    cut = every.withColumns({"full": full, "rest": F.col("n_tokens") % F.col("capacity")})
    whole = (
        cut.where("full > 0")
        .select("*", F.explode(F.sequence(F.lit(1), F.col("full"))).alias("piece_no"))
        .select("window_name", F.concat_ws("-", "window_name", "doc_id", "piece_no").alias("container_id"), "doc_id", "piece_no", ((F.col("piece_no") - 1) * F.col("capacity")).alias("start_token"), F.col("capacity").alias("n_tokens"), "source")
    )
    rest = cut.where("rest > 0 or n_tokens = 0").select("window_name", "capacity", "doc_id", (F.col("full") + 1).alias("piece_no"), (F.col("full") * F.col("capacity")).alias("start_token"), F.col("rest").alias("n_tokens"), "source")
    total = rest.groupBy("window_name", "source").agg(F.sum("n_tokens").alias("tokens"))
    by_name = Window.partitionBy("window_name")
    shares = total.select("window_name", "source", (F.col("tokens") / F.greatest(F.sum("tokens").over(by_name), F.lit(1))).alias("share"), F.sum("tokens").over(by_name).alias("all_tokens"))
    if targets is not None:
        shares = shares.drop("share").join(targets.select("source", "share"), "source", "left").na.fill(0.0, ["share"])
    rest = rest.join(shares, ["window_name", "source"])
    in_group = F.least(F.lit(GROUP_TOKENS), F.col("capacity") * GROUP_CONTAINERS)
    groups = F.greatest(F.ceil(F.col("all_tokens") / in_group), F.lit(1))
    rest = rest.withColumn("number", F.pmod(F.xxhash64("doc_id"), groups))
    sums = rest.groupBy("window_name", "number", "source", "share").agg(F.sum("n_tokens").alias("tokens"))
    sums = sums.withColumn("target", F.col("share") * F.sum("tokens").over(Window.partitionBy("window_name", "number")))
    placed = rest.join(opening_deficits(sums), ["window_name", "number", "source"]).groupBy("window_name", "number").applyInPandas(_pack_group, PLACED)
    return placed.unionByName(whole.select(*placed.columns))


def mixture_report(placed: DataFrame, windows: DataFrame) -> DataFrame:
    """``(window_name, containers, fill, distance)`` of packed containers, without those cut full from one text.

    ``distance`` is half the sum over sources of the differences between their share of a container
    and of all tokens packed, on average: 0 where every container holds the mixture.
    """
    held = placed.join(windows.select("window_name", F.col("capacity_tokens").cast("bigint").alias("capacity")), "window_name").where("n_tokens < capacity")
    parts = held.groupBy("window_name", "container_id", "capacity", "source").agg(F.sum("n_tokens").alias("tokens"))
    sums = parts.groupBy("window_name", "source").agg(F.sum("tokens").alias("tokens"))
    every = sums.groupBy("window_name").agg(F.sum("tokens").alias("all_tokens"))
    target = sums.join(every, "window_name").select("window_name", "source", (F.col("tokens") / F.greatest("all_tokens", F.lit(1))).alias("target"))
    total = parts.groupBy("window_name", "container_id", "capacity").agg(F.sum("tokens").alias("total"))
    share = F.col("tokens") / F.greatest("total", F.lit(1))
    far = parts.join(total, ["window_name", "container_id", "capacity"]).join(target, ["window_name", "source"]).groupBy("window_name", "container_id", "capacity", "total").agg(((F.sum(F.abs(share - F.col("target"))) + 1 - F.sum("target")) / 2).alias("distance"))
    return far.groupBy("window_name").agg(F.count("*").alias("containers"), F.round(F.sum("total") / F.sum("capacity"), 4).alias("fill"), F.round(F.avg("distance"), 4).alias("distance"))


def fill_report(placed: DataFrame, windows: DataFrame) -> DataFrame:
    """``(window_name, containers, tokens, fill)``: the share of the room that is used."""
    sums = placed.groupBy("window_name").agg(F.countDistinct("container_id").alias("containers"), F.sum("n_tokens").alias("tokens"))
    return sums.join(windows, "window_name").select("window_name", "containers", "tokens", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 4).alias("fill"))
