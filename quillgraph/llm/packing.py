"""Filling containers of fixed capacity by multiway differencing.

An item above the capacity is cut into full pieces and a rest; a full piece fills a
container alone. All rests are hashed into shards that hold about WINDOWS containers and
at most about ITEMS items each, so a shard has a bounded size however large the corpus
is. In a shard the Karmarkar-Karp method starts from one partial partition for each item,
a tuple of window sums with the item in the first, and always merges the two partitions of
largest imbalance, the heavy windows of one with the light ones of the other. It starts
at the least number of windows that any packing could have. Windows that come out full,
up to ROOM of the capacity, are closed. The items of all others, those above the capacity
too, are packed anew, the largest first, each where it leaves the least room; if one has
no room, the window count rises. At last windows whose items find room in others, also by
changing places with smaller items, are dissolved.

Shards and container ids follow from ids and sizes alone, so that the layout of the files
has no influence.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.session import checkpointed

#: Containers' worth of items in a shard, on average, and items of a shard, about.
WINDOWS, ITEMS = 192, 16_384
#: Room that a window may be closed with, as a share of the capacity.
ROOM = 0.01


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each item, by multiway differencing over ``windows`` windows."""
    n = len(sizes)
    if windows <= 1 or n == 0:
        return np.zeros(n, np.int64)
    # window sums, heaviest first; only those above zero are kept
    sums: list[np.ndarray | None] = [np.array([v], np.int64) for v in sizes]
    # a node made by merging is (left, right, order, used): order[i] is the place in left of the i-th heaviest window, of those used
    made: list[tuple[int, int, np.ndarray]] = []
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        x, y = sums[a], sums[b]
        # the heaviest of b goes to the lightest of a; as long as windows are free they do not meet
        used = min(windows, len(x) + len(y))
        both = np.zeros(used, np.int64)
        both[: len(x)] = x
        both[used - len(y) :] += y[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        sums[a] = sums[b] = None
        sums.append(both)
        made.append((a, b, order))
        heapq.heappush(heap, ((int(both[-1]) if used == windows else 0) - int(both[0]), n + len(made) - 1))
    place: list[np.ndarray | None] = [None] * (n + len(made))
    place[-1] = np.arange(windows)
    size_of = [1] * n + [len(order) for *_, order in made]
    for i in range(len(made) - 1, -1, -1):
        a, b, order = made[i]
        at = np.empty(len(order), np.int64)
        at[order] = place[n + i][: len(order)]
        place[a], place[b], place[n + i] = at[: size_of[a]], at[::-1][: size_of[b]], None
    return np.fromiter((place[i][0] for i in range(n)), np.int64, n)


def fewest(sizes: np.ndarray, capacity: int) -> int:
    """A number of containers that no packing can go below: by volume, and by items that can't share one."""
    least = -(-int(sizes.sum()) // capacity)
    ordered = np.sort(sizes)
    total = np.concatenate([[0], np.cumsum(ordered)])
    for small in np.unique(ordered[ordered <= capacity // 2]):
        alone = len(ordered) - int(np.searchsorted(ordered, capacity - small, "right"))
        half = int(np.searchsorted(ordered, capacity // 2, "right"))
        upto = len(ordered) - alone
        big = max(0, upto - half)
        low = int(np.searchsorted(ordered, small, "left"))
        room = big * capacity - int(total[upto] - total[min(half, upto)])
        rest = int(total[min(half, upto)] - total[low]) - room
        least = max(least, alone + big + max(0, -(-rest // capacity)))
    return max(least, len(ordered) - int(np.searchsorted(ordered, capacity // 2, "right")))


class Windows:
    """Windows with their items, ordered by the room they have."""

    def __init__(self, sizes: np.ndarray, window: np.ndarray, count: int, capacity: int):
        self.sizes, self.capacity = sizes.tolist(), capacity
        # items of a window from the smallest
        self.items: dict[int, list[tuple[int, int]]] = {w: [] for w in range(count)}
        for i in np.argsort(sizes, kind="stable").tolist():
            self.items[int(window[i])].append((self.sizes[i], i))
        self.free = {w: capacity - sum(s for s, _ in m) for w, m in self.items.items()}
        self.by_room = sorted((f, w) for w, f in self.free.items())

    def _set(self, w: int, free: int) -> None:
        self.by_room.pop(bisect_left(self.by_room, (self.free[w], w)))
        self.free[w] = free
        insort(self.by_room, (free, w))

    def add(self, w: int, i: int) -> None:
        insort(self.items[w], (self.sizes[i], i))
        self._set(w, self.free[w] - self.sizes[i])

    def take(self, w: int, i: int) -> None:
        own = self.items[w]
        own.pop(bisect_left(own, (self.sizes[i], i)))
        self._set(w, self.free[w] + self.sizes[i])

    def drop(self, w: int) -> None:
        self.by_room.pop(bisect_left(self.by_room, (self.free[w], w)))
        del self.items[w], self.free[w]

    def open(self, w: int) -> None:
        self.items[w], self.free[w] = [], self.capacity
        insort(self.by_room, (self.capacity, w))

    def unpack(self, most: float) -> list[int]:
        """Take apart the windows above capacity and those with more room than ``most``; their items, the largest first."""
        out = []
        for free, w in list(self.by_room):
            if not 0 <= free <= most:
                out += [i for _, i in self.items[w]]
                self.drop(w)
        return sorted(out, key=lambda i: (-self.sizes[i], i))

    def fits(self, i: int) -> int | None:
        """The window in which an item leaves the least room."""
        at = bisect_left(self.by_room, (self.sizes[i], -1))
        return self.by_room[at][1] if at < len(self.by_room) else None

    def settle(self, i: int, moves: list[tuple[str, int, int]]) -> bool:
        """Put an item where it leaves the least room; if it has none, it changes places with the smallest item that makes room, which is settled in turn."""
        while True:
            size = self.sizes[i]
            if (w := self.fits(i)) is not None:
                self.add(w, i)
                moves.append(("add", w, i))
                return True
            least = None
            for free, w in self.by_room:
                own = self.items[w]
                k = bisect_left(own, (size - free, -1))
                # a smaller item leaves each time, so this ends
                if k < len(own) and own[k][0] < size and (least is None or own[k][0] < least[0]):
                    least = (own[k][0], w, own[k][1])
            if least is None:
                return False
            _, w, other = least
            self.take(w, other)
            self.add(w, i)
            moves += [("take", w, other), ("add", w, i)]
            i = other

    def dissolve(self) -> None:
        """Empty the windows of most room where all their items find a place in others."""
        for _, w in sorted(self.by_room, reverse=True):
            if len(self.by_room) == 1 or sum(f for f, v in self.by_room if v != w) < self.capacity - self.free[w]:
                return
            own = [i for _, i in reversed(self.items[w])]
            self.drop(w)
            moves: list[tuple[str, int, int]] = []
            if not all(self.settle(i, moves) for i in own):
                for what, v, i in reversed(moves):
                    if what == "add":
                        self.take(v, i)
                    else:
                        self.add(v, i)
                self.open(w)
                for i in own:
                    self.add(w, i)
                return

    def numbered(self) -> np.ndarray:
        """The window of each item, counted from 0."""
        out = np.empty(len(self.sizes), np.int64)
        for k, own in enumerate(self.items.values()):
            out[[i for _, i in own]] = k
        return out


def pack_shard(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item of 1 to ``capacity``; none is above the capacity."""
    if len(sizes) == 0:
        return np.zeros(0, np.int64)
    count = fewest(sizes, capacity)
    own = Windows(sizes, differencing(sizes, count), count, capacity)
    for i in own.unpack(ROOM * capacity):
        if (w := own.fits(i)) is None:
            w, count = count, count + 1
            own.open(w)
        own.add(w, i)
    own.dissolve()
    return own.numbered()


def pack(items: DataFrame, containers: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens", windows: int = WINDOWS, most: int = ITEMS) -> DataFrame:
    """(container_kind, container_id, id, piece, start_token, n_tokens): every piece of every item, for each kind of container.

    piece counts from 0, start_token is its first token in the item. An item of size 0
    or null takes no room and has one row with a null container_id. Repeated rows are
    items of their own. Kinds with a null or non-positive capacity are left out.
    """
    spark = items.sparkSession
    # equal rows are counted first and numbered after, so that none of them depends on where it is stored
    equal = items.select(F.col(id_col).alias("id"), F.coalesce(F.col(size_col).cast("bigint"), F.lit(0)).alias("size")).groupBy("id", "size").agg(F.count("*").alias("n"))
    sized = checkpointed(equal.select("id", "size", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("copy")))
    kinds = sorted((r["container_kind"], int(r["capacity_tokens"])) for r in containers.where("capacity_tokens > 0 and container_kind is not null").select("container_kind", "capacity_tokens").distinct().collect())
    id_type = sized.schema["id"].dataType.simpleString()
    out = f"container_kind string, container_id string, id {id_type}, piece bigint, start_token bigint, n_tokens bigint"
    if not kinds:
        return spark.createDataFrame([], out).withColumnRenamed("id", id_col)
    rests = sized.agg(*[F.coalesce(F.sum(F.col("size") % c), F.lit(0)).alias(f"k{i}") for i, (_, c) in enumerate(kinds)], *[F.coalesce(F.sum((F.col("size") % c > 0).cast("bigint")), F.lit(0)).alias(f"n{i}") for i, (_, c) in enumerate(kinds)]).first()
    shards = [max(1, -(-int(rests[f"k{i}"]) // (c * windows)), -(-int(rests[f"n{i}"]) // most)) for i, (_, c) in enumerate(kinds)]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("container_kind"), F.lit(c).cast("bigint").alias("capacity"), F.lit(n).cast("bigint").alias("shards")) for (k, c), n in zip(kinds, shards)]))
    base = sized.withColumn("c", each).select("id", "size", "copy", "c.*").withColumn("full", F.expr("size div capacity")).withColumn("rest", F.expr("size % capacity"))
    key = F.concat_ws("-", "container_kind", F.coalesce(F.col("id").cast("string"), F.lit("null")), F.col("size").cast("string"), F.col("copy").cast("string"))
    whole = base.where("full > 0").select("container_kind", "id", "capacity", key.alias("key"), F.explode(F.expr("sequence(0, full - 1)")).alias("piece"))
    whole = whole.select("container_kind", F.concat_ws("-", "key", F.col("piece").cast("string")).alias("container_id"), "id", "piece", (F.col("piece") * F.col("capacity")).alias("start_token"), F.col("capacity").alias("n_tokens"))
    none = base.where("size <= 0").select("container_kind", F.lit(None).cast("string").alias("container_id"), "id", F.lit(0).cast("bigint").alias("piece"), F.lit(0).cast("bigint").alias("start_token"), F.lit(0).cast("bigint").alias("n_tokens"))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("rest", "descending"), ("id", "ascending"), ("copy", "ascending")])
        window = pack_shard(table["rest"].to_numpy(), table["capacity"][0].as_py())
        name = f"{table['container_kind'][0].as_py()}-{table['capacity'][0].as_py()}-s{table['shard'][0].as_py()}-"
        ids = pa.array([name + str(w) for w in window.tolist()], pa.string())
        return pa.table([table["container_kind"], ids, table["id"], table["piece"], table["start_token"], table["rest"]], names=["container_kind", "container_id", "id", "piece", "start_token", "n_tokens"])

    open_ = base.where("rest > 0").select("container_kind", "capacity", F.expr("pmod(xxhash64(id, size, copy), shards)").alias("shard"), "id", "copy", F.col("full").alias("piece"), (F.col("full") * F.col("capacity")).alias("start_token"), "rest")
    # the number of partitions is given, as shards of few bytes and much work must not be put together again
    partitions = max(min(sum(shards), 4 * spark.sparkContext.defaultParallelism), sum(shards) // 16)
    packed = open_.repartition(partitions, "container_kind", "capacity", "shard").groupBy("container_kind", "capacity", "shard").applyInArrow(run, out)
    return whole.unionByName(none).unionByName(packed).withColumnRenamed("id", id_col)


def fill(packed: DataFrame, containers: DataFrame) -> DataFrame:
    """(container_kind, capacity_tokens, n_containers, tokens, least, room_share): containers used, the number that no packing of these pieces can go below by volume, and the share of room unused.

    Kinds without containers are left out.
    """
    used = packed.where("container_id is not null").groupBy("container_kind", "container_id").agg(F.sum("n_tokens").alias("n")).groupBy("container_kind").agg(F.count("*").alias("n_containers"), F.sum("n").alias("tokens"))
    kinds = containers.where("capacity_tokens > 0").select("container_kind", "capacity_tokens").distinct()
    least = F.ceil(F.col("tokens") / F.col("capacity_tokens"))
    return used.join(F.broadcast(kinds), "container_kind").select("container_kind", "capacity_tokens", "n_containers", "tokens", least.alias("least"), F.round(1 - F.col("tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 6).alias("room_share"))
