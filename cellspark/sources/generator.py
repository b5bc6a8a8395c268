"""Deterministic synthetic rows from per-column distributions.

Each value is a function of (seed, row, column): the same profile gives the same table on
any cluster, and no state passes between tasks.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the shape of a distribution's text.
_FORM = re.compile(r"^(~?)([a-z]+)\((.*)\)$")
_ALIASES = {"extr": "extreme", "weibull": "extreme", "qextr": "qextreme",
            "gauss": "gaussian", "normal": "gaussian", "norm": "gaussian"}
_SUFFIX = {"k": 10**3, "m": 10**6, "b": 10**9}


def _number(text: str) -> int:
    text = text.strip().lower()
    return int(text[:-1]) * _SUFFIX[text[-1]] if text[-1] in _SUFFIX else int(text)


@dataclass(frozen=True)
class Distribution:
    kind: str
    low: int
    high: int
    params: tuple[float, ...] = ()
    inverted: bool = False

    @staticmethod
    def parse(text: str) -> "Distribution":
        m = _FORM.match(text.strip().lower())
        if not m:
            raise ValueError(f"not a distribution: {text}")
        kind = _ALIASES.get(m[2], m[2])
        first, *rest = [p.strip() for p in m[3].split(",")]
        if kind == "fixed":
            low = high = _number(first)
        else:
            low, high = (_number(x) for x in first.split(".."))
        if kind not in ("exp", "extreme", "qextreme", "gaussian", "uniform", "fixed", "seq"):
            raise ValueError(f"unknown distribution {kind}")
        return Distribution(kind, low, high, tuple(float(x) for x in rest), bool(m[1]))

    def sample(self, unit: Column, unit_2: Column, row: Column) -> Column:
        """A bigint in [low, high] from uniform numbers in [0, 1) (or from the row number)."""
        lo, hi, width = self.low, self.high, self.high - self.low
        if self.kind == "fixed" or width == 0:
            return F.lit(lo).cast("bigint")
        if self.kind == "seq":
            value = F.pmod(row, F.lit(width + 1)) + lo
        elif self.kind == "uniform":
            value = F.floor(unit * (width + 1)) + lo
        elif self.kind == "exp":
            # the far quantile of the largest of ``width`` draws sits at the upper bound
            mean = width / -math.log(math.sqrt(1 / width)) if width > 1 else 1.0
            value = F.floor(-F.log(1 - unit) * mean) + lo
        elif self.kind in ("extreme", "qextreme"):
            shape = self.params[0]
            edge = -math.log(math.sqrt(1 / width)) if width > 1 else 1.0
            scale = width / edge ** (1 / shape)
            value = F.floor(F.pow(-F.log(1 - unit), F.lit(1 / shape)) * scale) + lo
            if self.kind == "qextreme":
                # values are drawn uniformly inside equal slices of the range
                slices = max(1, int(self.params[1]))
                size = max(1, (width + 1) // slices)
                start = F.floor((value - lo) / size) * size + lo
                value = start + F.floor(unit_2 * size)
        else:
            if len(self.params) == 2:
                mean, stdev = self.params
            else:
                mean = (lo + hi) / 2
                stdev = (width / 2) / (self.params[0] if self.params else 3.0)
            normal = F.sqrt(-2 * F.log(1 - unit)) * F.cos(unit_2 * (2 * math.pi))
            value = F.round(normal * stdev + mean)
        bounded = F.least(F.greatest(value.cast("bigint"), F.lit(lo)), F.lit(hi)).cast("bigint")
        return (lo + hi - bounded) if self.inverted else bounded


@dataclass(frozen=True)
class ColumnProfile:
    name: str
    kind: str = "bigint"  # bigint int text boolean double timestamp date uuid timeuuid blob inet
    population: str = "uniform(1..100b)"
    size: str = "uniform(4..8)"
    cluster: str = "fixed(1)"


@dataclass(frozen=True)
class Profile:
    partition_key: list[ColumnProfile]
    clustering: list[ColumnProfile] = field(default_factory=list)
    regular: list[ColumnProfile] = field(default_factory=list)
    seed: int = 1
    select_ratio: str = "fixed(1)/1"  # share of a partition's rows that are visited


def _unit(seed: int, name: str, salt: int, *parts: Column) -> Column:
    h = F.xxhash64(F.lit(seed), F.lit(name), F.lit(salt), *parts)
    return F.shiftrightunsigned(h, 11) * F.lit(2.0 ** -53)


def _draw(p: ColumnProfile, what: str, seed: int, row: Column, *parts: Column) -> Column:
    d = Distribution.parse(getattr(p, what))
    return d.sample(_unit(seed, f"{p.name}/{what}", 1, *parts), _unit(seed, f"{p.name}/{what}", 2, *parts), row)


def _value(p: ColumnProfile, identity: Column, seed: int) -> Column:
    """The value of a population member: the same member always looks the same."""
    h = F.xxhash64(F.lit(p.name), F.lit(seed), identity)
    if p.kind == "bigint":
        return identity
    if p.kind in ("int", "smallint", "tinyint"):
        return F.pmod(identity, F.lit({"int": 2**31, "smallint": 2**15, "tinyint": 2**7}[p.kind])).cast(p.kind)
    if p.kind in ("double", "float"):
        return (F.pmod(h, F.lit(10**9)) / 1000).cast(p.kind)
    if p.kind == "boolean":
        return F.pmod(identity, F.lit(2)) == 1
    if p.kind == "timestamp":
        return F.timestamp_millis(F.pmod(h, F.lit(2 * 10**12)))
    if p.kind == "date":
        return F.date_from_unix_date(F.pmod(h, F.lit(25000)).cast("int"))
    if p.kind == "uuid":
        d = F.md5(h.cast("string"))
        return F.regexp_replace(d, "(.{8})(.{4}).(.{3}).(.{3})(.{12})", "$1-$2-4$3-8$4-$5")
    if p.kind == "timeuuid":
        from cellspark.functions.timeuuid import timeuuid_of

        return timeuuid_of(F.timestamp_millis(F.pmod(h, F.lit(2 * 10**12))), h.cast("string"))
    if p.kind == "inet":
        octet = lambda n: F.pmod(F.shiftright(h, n), F.lit(256)).cast("string")
        return F.concat_ws(".", octet(0), octet(8), octet(16), octet(24))
    size = _draw(p, "size", seed, identity, identity)
    text = F.substring(F.repeat(F.sha2(h.cast("string"), 256), 1 + Distribution.parse(p.size).high // 64), 1, 1 << 30)
    cut = text.substr(F.lit(1), size.cast("int"))
    if p.kind == "text":
        return cut
    if p.kind == "blob":
        return F.encode(cut, "UTF-8")
    raise ValueError(f"no generator for {p.kind}")


def generate(profile: Profile, partitions: DataFrame, seed_column: str = "id") -> DataFrame:
    """Rows for each partition seed (a bigint column), exploded over clustering columns."""
    seed = profile.seed
    s = F.col("_s")
    rows = partitions.select(F.col(seed_column).cast("bigint").alias("_s"))
    for p in profile.partition_key:
        rows = rows.withColumn(p.name, _value(p, _draw(p, "population", seed, s, s), seed))
    path: list[Column] = [s]
    for level, p in enumerate(profile.clustering):
        n = _draw(p, "cluster", seed, s, *path)
        index = f"_i{level}"
        rows = rows.withColumn(index, F.explode(F.sequence(F.lit(1).cast("bigint"), F.greatest(n, F.lit(1)))))
        path = [*path, F.col(index)]
        rows = rows.withColumn(p.name, _value(p, _draw(p, "population", seed, F.col(index), *path), seed))
    ratio, _, per = profile.select_ratio.partition("/")
    share = Distribution.parse(ratio).sample(_unit(seed, "select", 1, s), _unit(seed, "select", 2, s), s)
    rows = rows.filter(_unit(seed, "visit", 1, *path) * float(per or 1) < share)
    values = [_value(p, _draw(p, "population", seed, s, *path), seed).alias(p.name) for p in profile.regular]
    keys = [p.name for p in profile.partition_key + profile.clustering]
    return rows.select(*keys, *values)


def generate_range(spark: SparkSession, profile: Profile, n_partitions: int) -> DataFrame:
    return generate(profile, spark.range(n_partitions), "id")
