"""Problem 8: filling fixed-capacity containers with items, leaving little space.

Linear grouping on the histogram of sizes (at most capacity + 1 values, whatever the corpus):
1. An item above the capacity is split into full containers and a rest; nothing else is split.
2. Large sizes are cut into groups of equal cardinality and rounded up to the group's largest size.
3. Configurations of the few rounded sizes are chosen one after the other: a knapsack over the groups
   still open finds the fullest one, used as often as the groups last.
4. Real items take the rounded places, largest first, so containers fall into classes of equal content.
5. Small items go best-fit into the room left, class by class; what is left opens new containers.
The plan is a table of (size, first rank, count, first container). Executors rank items within their
size by blocks of bounded size (no size is ever in one task) and look their container up.

Edge cases: null and empty texts have size 0 and spread over all containers; ties of size are ranked by
block and key; a corpus of only empty texts uses one container; an empty table gives no rows; repeated
rows are items of their own; extra columns are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from formloom.llm.tokens import token_sizes
from formloom.session import cut

CAPACITY = 2048
GROUPS = 48
#: Sizes from this share of the capacity on are large.
LARGE = 1 / 8
#: Rows of a block, in which the items of a size are ranked: there are as many blocks as the items need.
BLOCK_ROWS = 100_000

Plan = list[tuple[int, int, int, int]]  # size, first rank, count, first container


def group_sizes(hist: dict[int, int], groups: int) -> list[tuple[int, list[list[int]]]]:
    """[(rounded size, [[size, count], ...])], largest first, groups of equal cardinality."""
    total = sum(hist.values())
    quota = max(1, -(-total // groups))
    out: list[tuple[int, list[list[int]]]] = []
    room = 0
    for s in sorted(hist, reverse=True):
        left = hist[s]
        while left:
            if not room:
                out.append((s, []))
                room = quota
            n = min(left, room)
            out[-1][1].append([s, n])
            left -= n
            room -= n
    return out


def fullest(sizes: list[int], counts: list[int], capacity: int) -> list[int]:
    """How many of each size fill the capacity best (bounded knapsack, weight = value)."""
    reach = np.full(capacity + 1, -1, np.int32)  # last group used to reach a sum
    took = np.zeros(capacity + 1, np.int32)
    reach[0] = len(sizes)
    for g, (s, n) in enumerate(zip(sizes, counts)):
        if not n or s > capacity or not s:
            continue
        used = np.full(capacity + 1, -1, np.int32)
        used[reach >= 0] = 0
        for t in range(s, capacity + 1):
            if reach[t] < 0 and used[t - s] >= 0 and used[t - s] < n:
                used[t] = used[t - s] + 1
                reach[t] = g
                took[t] = used[t]
        if reach[capacity] >= 0:
            break
    t = int(np.max(np.nonzero(reach >= 0)[0]))
    out = [0] * len(sizes)
    while t:
        g = int(reach[t])
        k = int(took[t])
        out[g] += k
        t -= k * sizes[g]
    return out


def plan_containers(hist: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: float = LARGE) -> tuple[Plan, int]:
    """(plan, number of containers) for items of sizes 1..capacity."""
    hist = {s: n for s, n in hist.items() if n and 0 < s <= capacity}
    ranks = dict.fromkeys(hist, 0)
    plan: Plan = []
    n_containers = 0
    rooms: dict[int, list[list[int]]] = {}  # room left -> [[first container, count], ...]
    open_rooms: list[int] = []

    def free(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in rooms:
                rooms[room] = []
                bisect.insort(open_rooms, room)
            rooms[room].append([first, count])

    def place(size: int, count: int, first: int) -> None:
        plan.append((size, ranks[size], count, first))
        ranks[size] += count

    border = max(1, int(capacity * large))
    grouped = group_sizes({s: n for s, n in hist.items() if s > border}, groups)
    tops = [g[0] for g in grouped]
    left = [sum(n for _, n in g[1]) for g in grouped]
    while any(left):
        conf = fullest(tops, left, capacity)
        times = min(left[g] // k for g, k in enumerate(conf) if k)
        # classes: stretches of containers whose real sizes are equal
        spans = [[n_containers, times, capacity]]
        for g, k in enumerate(conf):
            left[g] -= k * times
            for _ in range(k):
                new = []
                for first, count, room in spans:
                    while count:
                        run = grouped[g][1][0]
                        n = min(count, run[1])
                        place(run[0], n, first)
                        new.append([first, n, room - run[0]])
                        run[1] -= n
                        if not run[1]:
                            grouped[g][1].pop(0)
                        first += n
                        count -= n
                spans = new
        n_containers += times
        for first, count, room in spans:
            free(room, first, count)
    small = {s: n for s, n in hist.items() if s <= border}
    for s in sorted(small, reverse=True):
        need = small[s]
        while need:
            i = bisect.bisect_left(open_rooms, s)
            if i == len(open_rooms):
                break
            room = open_rooms[i]
            first, count = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                open_rooms.pop(i)
            n = min(need, count)
            place(s, n, first)
            need -= n
            free(room, first + n, count - n)
            free(room - s, first, n)
        small[s] = need
    sizes = sorted((s for s in small if small[s]), reverse=True)
    while sizes:
        conf = fullest(sizes, [small[s] for s in sizes], capacity)
        times = min(small[s] // k for s, k in zip(sizes, conf) if k)
        for s, k in zip(sizes, conf):
            for _ in range(k):
                place(s, times, n_containers)
            small[s] -= k * times
        n_containers += times
        sizes = [s for s in sizes if small[s]]
    return plan, n_containers


def pack(items: DataFrame, key: str, size: str, capacity: int = CAPACITY, groups: int = GROUPS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(key, piece, token_start, token_end, n_tokens, container_id): every item once, or in pieces above the capacity.

    Only the histogram (capacity + 1 rows at most) comes to the driver. Ranks within a size are made of the
    rank within a block and the sizes of the blocks before it, so two runs give the same containers.
    """
    spark = items.sparkSession
    n = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long")
    # rows of one key and size are alike: counted once, told apart at the end
    parts = cut(items.groupBy(key, n.alias("_n")).agg(F.count("*").alias("_m")), "items")
    blocks = max(1, -(-parts.count() // block_rows))
    parts = parts.withColumn("_full", F.floor(F.col("_n") / capacity)).withColumn("_rest", F.col("_n") % capacity)
    parts = parts.withColumn("_b", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))
    tally = parts.groupBy("_rest", "_b").agg(F.sum("_m").alias("n"), F.sum(F.col("_full") * F.col("_m")).alias("full"))
    hist, fulls = {}, {}
    for r in tally.groupBy("_rest").agg(F.sum("n").alias("n"), F.sum("full").alias("full")).collect():  # at most `capacity` rows, whatever the corpus
        hist[r["_rest"]], fulls[r["_rest"]] = r["n"], r["full"]
    plan, n_containers = plan_containers({s: n for s, n in hist.items() if s}, capacity, groups)
    full_start: dict[int, int] = {}
    at = n_containers
    for rest in sorted(fulls):
        full_start[rest] = at
        at += fulls[rest]
    spread = max(1, at)
    by_size: dict[int, list[tuple[int, int, int]]] = {}
    for s, lo, count, first in plan:
        by_size.setdefault(s, []).append((lo, count, first))
    table = {s: tuple(np.asarray(x, np.int64) for x in zip(*sorted(v))) for s, v in by_size.items()}
    shared = spark.sparkContext.broadcast((table, full_start))  # bounded by the capacity and the classes of containers
    before = Window.partitionBy("_rest").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    starts = tally.select("_rest", "_b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_s"), F.coalesce(F.sum("full").over(before), F.lit(0)).alias("_sf"))
    w = Window.partitionBy("_rest", "_b").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    ranked = parts.withColumn("_r", F.coalesce(F.sum("_m").over(w), F.lit(0))).withColumn("_f", F.coalesce(F.sum(F.col("_full") * F.col("_m")).over(w), F.lit(0)))
    ranked = ranked.join(starts, ["_rest", "_b"]).select(key, "_n", "_full", "_rest", (F.col("_s") + F.col("_r")).alias("_r"), (F.col("_sf") + F.col("_f")).alias("_f"), F.explode(F.sequence(F.lit(0), F.col("_m") - 1)).alias("_c"))
    ranked = ranked.select(key, "_n", "_full", "_rest", (F.col("_r") + F.col("_c")).alias("_r"), (F.col("_f") + F.col("_c") * F.col("_full")).alias("_f"))
    kind = dict(items.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, full_start = shared.value
        for b in batches:
            pdf = b.to_pandas()
            out = []
            for k, n, full, rest, r, f in zip(pdf[key], pdf["_n"], pdf["_full"], pdf["_rest"], pdf["_r"], pdf["_f"]):
                for p in range(int(full)):
                    out.append((k, p, p * capacity, (p + 1) * capacity, capacity, full_start[rest] + int(f) + p))
                if rest:
                    lo, count, first = table[rest]
                    i = int(np.searchsorted(lo, r, side="right")) - 1
                    out.append((k, int(full), int(full) * capacity, n, rest, int(first[i] + r - lo[i])))
                elif not full:
                    out.append((k, 0, 0, 0, 0, int(r % spread)))
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=[key, "piece", "token_start", "token_end", "n_tokens", "container_id"]), schema=schema, preserve_index=False)

    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    schema = pa.schema([(key, types[kind]), ("piece", pa.int32()), ("token_start", pa.int64()), ("token_end", pa.int64()), ("n_tokens", pa.int64()), ("container_id", pa.int64())])
    return ranked.mapInArrow(run, f"{key} {kind}, piece int, token_start long, token_end long, n_tokens long, container_id long")


def p8_containers(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    return pack(token_sizes(docs.select("doc_id", "text"), vocabulary=vocabulary), "doc_id", "n_tokens", capacity)
