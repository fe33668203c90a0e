"""Weighted mixtures of datasets: weights, lengths, deduplication and deterministic draws."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstep.operators.windows import place_in_order

FLOOR = 1e-8
U, MASK = np.uint64, (1 << 32) - 1


def first_of_each(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key by the order; used for mixtures listed twice and, descending, for overriding registries."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def dataset_weights(df: DataFrame, weight: str, length: str | None = None, name: str = "share") -> DataFrame:
    """Shares of the datasets, by weight or by weight times length; uniform if none has a usable weight. The window runs
    over datasets, one row each."""
    w = Window.partitionBy()
    raw = F.col(weight).cast("double") * (F.col(length) if length else F.lit(1.0))
    usable = F.when(F.isnan(raw) | raw.isNull(), 0.0).otherwise(raw)
    total = F.sum(usable).over(w)
    floored = F.greatest(usable, F.lit(FLOOR))
    return df.withColumn(name, F.when(total > 0, floored / F.sum(floored).over(w)).otherwise(1.0 / F.count(F.lit(1)).over(w)))


def episode_weights(df: DataFrame, dataset: Sequence[str], length: str, by_length: bool = True, valid: Column | None = None, name: str = "share") -> DataFrame:
    """Shares of episodes within their dataset; episodes without a valid base get none."""
    w = Window.partitionBy(*dataset)
    raw = F.col(length).cast("double") if by_length else F.lit(1.0)
    raw = F.when(valid, raw).otherwise(0.0) if valid is not None else raw
    return df.withColumn(name, F.coalesce(F.try_divide(raw, F.sum(raw).over(w)), F.lit(0.0)))


def primary(df: DataFrame, weight: str, name: str = "is_primary") -> DataFrame:
    """Datasets of weight one; if there is none, those of the largest weight."""
    w = Window.partitionBy()
    one = F.col(weight) == 1.0
    return df.withColumn(name, F.when(F.max(one.cast("int")).over(w) == 1, one).otherwise(F.col(weight) == F.max(weight).over(w)))


def mixture_length(df: DataFrame, length: str, share: str, is_primary: str = "is_primary") -> DataFrame:
    """Draws until every primary dataset is expected to have been seen in full."""
    return df.where(F.col(is_primary)).agg(F.floor(F.max(F.col(length) / F.col(share))).alias("epoch_length"))


def hash_unit(*parts: Column) -> Column:
    """A number in [0, 1) from an md5 of the parts: the same in any engine that has md5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def cumulative(df: DataFrame, share: str, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """[low, high) of each row's share in [0, 1) and, as ``among``, how many rows share it. The last range is closed at 1, where
    a running sum of rounded shares may fall short of it."""
    w = Window.partitionBy(*by).orderBy(*order)
    upto = F.sum(share).over(w)
    last = F.row_number().over(w) == F.count(F.lit(1)).over(Window.partitionBy(*by))
    return df.withColumns({"low": upto - F.col(share), "high": F.when(last, F.lit(1.0)).otherwise(upto), "among": F.count(F.lit(1)).over(Window.partitionBy(*by))})


def draw(indices: DataFrame, ranges: DataFrame, unit: Column, pick: Sequence[str], by: Sequence[str] = (), among: str | None = None) -> DataFrame:
    """Each index with the row whose range holds its number. [0, 1) is cut into as many cells as there are ranges (of a group,
    with ``by``): a range is listed in the cells that it touches, so it joins by equality, and no pairs are tried. ``among``
    names the indices' column with that number; without it, it is counted here."""
    keys, names = list(by), [c for c in indices.columns if c != among]
    own = indices.withColumn("__u", unit)
    if among is None:
        n = ranges.count()
        own = own.withColumn("__among", F.lit(max(n, 1)))
    else:
        own = own.withColumn("__among", F.col(among))
    own = own.withColumn("__cell", F.floor(F.col("__u") * F.col("__among"))).drop("__among")
    touched = F.sequence(F.floor(F.col("low") * F.col("among")), F.least(F.floor(F.col("high") * F.col("among")), F.col("among") - 1))
    cells = ranges.where("low < high").select(*keys, *pick, "low", "high", F.explode(touched).alias("__cell"))
    hit = (F.col("__u") >= F.col("low")) & (F.col("__u") < F.col("high"))
    return own.join(cells, [*keys, "__cell"]).where(hit).select(*dict.fromkeys([*keys, *names, *pick]))


def hierarchical_draw(indices: DataFrame, datasets: DataFrame, episodes: DataFrame, epoch: int, seed: int) -> DataFrame:
    """(index, dataset, episode, step): a dataset by its share, an episode of it by its share there, and a step of it, all from
    hashes of (epoch, index, seed). ``datasets`` has (dataset, share), ``episodes`` (dataset, episode, share, steps); episodes
    without a share are never drawn."""
    unit = lambda level: hash_unit(F.lit(epoch), F.col("index"), F.lit(seed), F.lit(level))
    able = cumulative(episodes.where("share > 0"), "share", ["episode"], ["dataset"])
    counts = able.groupBy("dataset").agg(F.max("among").alias("episodes"))
    ranges = cumulative(datasets.join(counts, "dataset"), "share", ["dataset"])
    of = draw(indices, ranges, unit(0), ["dataset", "episodes"])
    of = draw(of, able, unit(1), ["episode", "steps"], by=["dataset"], among="episodes")
    return of.select("index", "dataset", "episode", F.floor(unit(2) * F.col("steps")).alias("step"))


def normal(*parts: Column) -> Column:
    """A standard normal number from hashes of the parts, by the polar form of two numbers in [0, 1)."""
    return F.sqrt(-2 * F.log(1 - hash_unit(*parts, F.lit("r")))) * F.cos(F.lit(2 * math.pi) * hash_unit(*parts, F.lit("a")))


def perturb(vector: Column, std: float, *key: Column) -> Column:
    """The vector with a normal number of its own added to each element, within the vector's own extremes. The noise follows
    from the key and the element's place. Lambdas see nothing but their elements, so the extremes are found once."""
    bounds = F.array_repeat(F.struct(F.array_min(vector).alias("low"), F.array_max(vector).alias("high")), F.size(vector))
    at = F.transform(F.arrays_zip(vector.alias("x"), bounds.alias("b")), lambda e, i: F.greatest(e["b"]["low"], F.least(e["b"]["high"], e["x"] + F.lit(std) * normal(*key, i))))
    return at


def drop_out(vector: Column, p: float, *key: Column) -> Column:
    """Zeros in place of the whole vector with probability ``p``, by a hash of the key."""
    return F.when(hash_unit(*key) < p, F.transform(vector, lambda x: F.lit(0.0))).otherwise(vector)


CATALOGUE = 1_000_000  # episodes that every worker may hold for exact draws


def catalogue_of(datasets: DataFrame, episodes: DataFrame) -> tuple[dict[int, list[float]], dict[int, list[int]], list[float]]:
    """(shares, lengths, weights) for :func:`exact_draw` from tables as :func:`hierarchical_draw` takes them: datasets by name
    and episodes by id are numbered from 0. Every worker holds them, so their number is checked."""
    rows = episodes.where("share > 0").select("dataset", "episode", "share", "steps").limit(CATALOGUE + 1).toArrow().to_pandas()
    if len(rows) > CATALOGUE:
        raise ValueError(f"more than {CATALOGUE} episodes: use hierarchical_draw")
    of = dict(list(rows.sort_values(["episode", "share", "steps"]).groupby("dataset", sort=False)))
    names = sorted((r["dataset"], r["share"]) for r in datasets.collect() if r["dataset"] in of)
    shares, lengths = {}, {}
    for k, (name, _) in enumerate(names):
        own = of[name]["share"].tolist()
        total = sum(own)
        shares[k], lengths[k] = [x / total for x in own], of[name]["steps"].tolist()
    total = sum(w for _, w in names)
    return shares, lengths, [w / total for _, w in names]


def _cumulated(shares: Sequence[float]) -> np.ndarray:
    """The sums that ``Generator.choice`` searches, refused where it refuses the shares."""
    p = np.asarray(shares, float)
    if not (p >= 0).all() or abs(math.fsum(p) - 1) > math.sqrt(np.finfo(float).eps):
        raise ValueError("shares must be at least 0 and sum to 1")
    upto = p.cumsum()
    return upto / upto[-1]


def _three_numbers(words: np.ndarray) -> list[np.ndarray]:
    """The first three 64-bit numbers of numpy's PCG64 for each seed of four 32-bit words (least first, held as 64-bit numbers):
    what SeedSequence and PCG64 do, for all rows together."""
    const = 0x43B0D7E5

    def hashed(x: np.ndarray, factor: int) -> np.ndarray:
        nonlocal const
        x = x ^ U(const)
        const = const * factor & MASK
        x = x * U(const) & U(MASK)
        return x ^ (x >> U(16))

    pool = [hashed(words[:, k], 0x931E8875) for k in range(4)]
    for source in range(4):
        for to in range(4):
            if source != to:
                x = (pool[to] * U(0xCA01F9DD) - hashed(pool[source], 0x931E8875) * U(0x4973F715)) & U(MASK)
                pool[to] = x ^ (x >> U(16))
    const = 0x8B51F9DD
    half = [hashed(pool[k % 4], 0x58F38DED) for k in range(8)]
    begin_high, begin_low, step_high, step_low = (half[2 * k] | (half[2 * k + 1] << U(32)) for k in range(4))
    step_high, step_low = (step_high << U(1)) | (step_low >> U(63)), (step_low << U(1)) | U(1)

    def plus(high: np.ndarray, low: np.ndarray, more_high: np.ndarray, more_low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = low + more_low
        return high + more_high + (total < low), total

    def advanced(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        times_high, times_low = U(0x2360ED051FC65DA4), U(0x4385DF649FCCF645)
        a, b, c, d = low >> U(32), low & U(MASK), times_low >> U(32), times_low & U(MASK)
        middle = (b * d >> U(32)) + (a * d & U(MASK)) + (b * c & U(MASK))
        carried = a * c + (a * d >> U(32)) + (b * c >> U(32)) + (middle >> U(32))
        return plus(carried + high * times_low + low * times_high, low * times_low, step_high, step_low)

    high, low = advanced(*plus(step_high, step_low, begin_high, begin_low))
    out = []
    for _ in range(3):
        high, low = advanced(high, low)
        x, turn = high ^ low, high >> U(58)
        out.append((x >> turn) | (x << ((U(64) - turn) & U(63))))
    return out


def exact_draw(indices: DataFrame, shares: dict[int, list[float]], lengths: dict[int, list[int]], weights: list[float], seed: int, epoch: int = 0) -> DataFrame:
    """Dataset, episode and step of each index by numpy's generator, seeded with the low 128 bits of a sha-256 of
    (epoch, index, seed): the draws that a per-sample loader would make, in Arrow batches. ``Generator.choice`` would add up all
    shares again for every draw; they are added up once, and a draw is a search in the sums, as there. The generators of a batch
    are run together. An episode's steps are less than 2^32."""

    known = indices.sparkSession.sparkContext.broadcast((_cumulated(weights), {d: _cumulated(of) for d, of in shares.items()}, {d: np.array(of, np.int64) for d, of in lengths.items()}))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upto, within, steps = known.value
        for b in batches:
            index = b["index"].to_numpy(np.int64)
            low = b"".join([hashlib.sha256(repr((epoch, i, seed)).encode()).digest()[16:] for i in index.tolist()])
            first, second, third = _three_numbers(np.frombuffer(low, ">u4").reshape(-1, 4)[:, ::-1].astype(U))
            d = upto.searchsorted((first >> U(11)) / float(1 << 53), "right")
            v, e, step = (second >> U(11)) / float(1 << 53), np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            for k in np.unique(d).tolist():
                mine = d == k
                e[mine] = within[k].searchsorted(v[mine], "right")
                n = steps[k][e[mine]].astype(U)
                wide = (third[mine] & U(MASK)) * n  # a whole number below n is the product's upper half
                step[mine] = wide >> U(32)
                for at in np.flatnonzero(mine)[(wide & U(MASK)) < n]:  # where numpy may draw again
                    rng = np.random.Generator(np.random.PCG64(int.from_bytes(low[16 * at : 16 * at + 16])))
                    rng.random(2)
                    step[at] = rng.integers(0, steps[k][e[at]])
            yield pd.DataFrame({"index": index, "dataset": d.astype(np.int32), "episode": e.astype(np.int32), "step": step})

    return indices.select(F.col("index").cast("long")).mapInPandas(run, "index long, dataset int, episode int, step long")


def shuffled(df: DataFrame, key: str, seed: int = 0, name: str = "place", cells: int = 1 << 12) -> DataFrame:
    """Each row's place in the order of its key's hash. Places count on from cell to cell of the hash, so the only window over
    everything runs over the cells' counts."""
    own = df.withColumn("__u", hash_unit(F.lit(seed), F.col(key))).withColumn("__cell", F.floor(F.col("__u") * cells))
    counts = own.groupBy("__cell").agg(F.count("*").alias("__n"))
    before = counts.select("__cell", (F.sum("__n").over(Window.orderBy("__cell")) - F.col("__n")).alias("__before"))
    own = own.withColumn(name, F.row_number().over(Window.partitionBy("__cell").orderBy("__u", key)) - 1).join(before, "__cell")
    return own.withColumn(name, (F.col(name) + F.col("__before")).cast("long")).drop("__u", "__cell", "__before")


def exact_sample(df: DataFrame, key: str, fraction: float, seed: int = 0, cells: int = 1 << 16) -> DataFrame:
    """int(n x fraction) rows without replacement, those of the least hash of their key. Hashes are counted by cell; all rows
    below the cell in which the number is reached are taken as they are, and only that cell's rows are ordered."""
    own = df.withColumn("__u", hash_unit(F.lit(seed), F.col(key)))
    cell = F.floor(F.col("__u") * cells)
    counts = sorted((r["cell"], r["n"]) for r in own.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect())
    wanted, at = int(sum(n for _, n in counts) * fraction), 0
    for c, n in counts:  # at most ``cells`` counts
        if at + n > wanted:
            edge = own.where(cell == c).orderBy("__u", key).limit(wanted - at)
            return own.where(cell < c).unionByName(edge).drop("__u")
        at += n
    return df


def replay(df: DataFrame, order: str, batch: int, first: int, batches: int) -> DataFrame:
    """(pass, batch, rows of ``df``): ``batches`` batches from number ``first`` of an endless run over finite data, which begins
    again after its last, shorter batch. ``order`` is a whole-number key without repeats; a pass is never stored, only its
    number."""
    placed = place_in_order(df, order, "__at").withColumn("__slot", F.floor(F.col("__at") / batch))
    each = -(-df.count() // batch)
    if not each:
        return placed.drop("__at", "__slot").select(F.lit(0).cast("long").alias("pass"), F.lit(0).cast("long").alias("batch"), "*").where("false")
    wanted = df.sparkSession.range(first, first + batches).select(F.col("id").alias("batch"), F.floor(F.col("id") / each).alias("pass"), (F.col("id") % each).alias("__slot"))
    return wanted.join(placed, "__slot").select("pass", "batch", *df.columns)


def sampling_rate(name: Column) -> Column:
    """The percentage behind a dataset's name (name%NN), as a fraction; 1 without one."""
    digits = F.regexp_extract(name, r"%(\d+)$", 1)
    return F.when(digits == "", F.lit(1.0)).otherwise(F.try_to_number(F.concat(F.lit("0"), digits), F.lit("9999999999")).cast("double") / 100)


def first_valid(requests: DataFrame, candidates: DataFrame, size: int, attempts: int, stride: int = 7919, unresolved: bool = False) -> DataFrame:
    """For each requested index the first candidate by attempt that is valid; attempts step on by an odd stride. With
    ``unresolved`` an index without a valid candidate keeps its row, with nulls."""
    tried = requests.select("index", F.explode(F.sequence(F.lit(0), F.lit(attempts - 1))).alias("attempt"))
    tried = tried.withColumn("candidate", F.pmod(F.col("index") + F.col("attempt") * stride, F.lit(size)))
    good = candidates.where("valid").select(F.col("index").alias("candidate"))
    found = tried.join(good, "candidate").groupBy("index").agg(F.min_by("candidate", "attempt").alias("candidate"), F.min("attempt").alias("attempt"))
    return requests.select("index").join(found, "index", "left") if unresolved else found
