"""URL filters by a Bloom filter cascade.

Listed keys are host names; a key stands for its host and every subdomain, so a
host is looked up by its endings of as many labels as listed keys have.
Level 0 encodes the listed keys. The keys of the corpus that are not listed and
yet hit level 0 are its false positives; level 1 encodes them. The listed keys
that hit level 1 are encoded by level 2, and so on, until a level has no false
positive left. As the corpus's complete key universe took part, every later
lookup of one of its keys is exact, and it needs no join: only the filters, of
a size that is computed, checked and independent of the corpus, go to the tasks.

Level 0 takes a false positive rate of |listed| / (1.41 |universe|), so that the
set of level 1 is about as large as the list; the others take 1/2. The filters
are bounded by ``max_bytes``; a longer list raises ValueError.

Edge cases: a null url, or one without ``://``, has empty host and path, fits no
rule and is allowed. Of rules that fit, the longest wins, of equally long ones that
with the longer host. Very long urls are judged whole, in
time in proportion to their length. Repeated rows are judged alike; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import gather_bits, staged, table
from tidemark.sources.ship import ship

MAX_FILTER_BYTES = 64 << 20


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the contract.
RULES = (
    Rule("com", "/en/", "block"),
    Rule("example.com", "/en/7", "allow"),
    Rule("net", "/de/", "allow"),
    Rule("example.net", "/de/8", "block"),
    Rule("org", "/es/", "block"),
)

#: The listed keys of the production query: each name under every ending.
LISTED_HOSTS = tuple(f"{name}.example.{ending}" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm") for ending in ("com", "net", "org"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + F.lit(1)), r"^[^?#]*", 0)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase), path


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The rule text and the verdict of the longest fitting rule, null without one."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def endings(host: str, depths: tuple[int, ...]) -> list[str]:
    """The domains of the host with so many labels."""
    labels = host.split(".")
    return [".".join(labels[-d:]) for d in depths if d <= len(labels)]


@dataclass
class Level:
    """One Bloom filter: bits as words of 64, k probes by double hashing."""

    words: np.ndarray
    n_bits: int
    n_probes: int
    seed: int

    def probes(self, key: str) -> list[int]:
        h = xxhash.xxh128_intdigest(key.encode(), seed=self.seed)
        a, b = h & 0xFFFFFFFFFFFFFFFF, (h >> 64) | 1
        return [(a + i * b) % self.n_bits for i in range(self.n_probes)]

    def __contains__(self, key: str) -> bool:
        return all(int(self.words[p >> 6]) >> (p & 63) & 1 for p in self.probes(key))


@dataclass
class Cascade:
    """depths: the numbers of labels of listed keys."""

    levels: list[Level]
    depths: tuple[int, ...] = ()

    def __contains__(self, key: str) -> bool:
        for i, level in enumerate(self.levels):
            if key not in level:
                return i % 2 == 1
        return len(self.levels) % 2 == 1

    def lists(self, host: str) -> bool:
        return any(key in self for key in endings(host, self.depths) if key)


def _shape(n_keys: int, rate: float, max_bytes: int) -> tuple[int, int]:
    bits = max(64, math.ceil(n_keys * math.log(1 / rate) / math.log(2) ** 2))
    if bits > 8 * max_bytes:
        raise ValueError(f"a filter of {n_keys} keys takes {bits // 8} bytes, more than {max_bytes}; split the list by key hash")
    return bits, max(1, round(bits / max(1, n_keys) * math.log(2)))


def _build_level(keys: DataFrame, n_keys: int, rate: float, seed: int, max_bytes: int) -> Level:
    """Sets the bits on the executors; what is gathered is the filter's own words."""
    bits, probes = _shape(n_keys, rate, max_bytes)
    empty = Level(np.zeros(0, np.uint64), bits, probes, seed)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {p for key in batch.column(0).to_pylist() for p in empty.probes(key)}
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64())], ["place"])

    return Level(gather_bits(keys.mapInArrow(places, "place long"), bits), bits, probes, seed)


def _hits(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([k for k in batch.column(0).to_pylist() if k in own], pa.string())], ["key"])

    return keys.mapInArrow(keep, "key string")


def label_depths(listed: DataFrame) -> tuple[int, ...]:
    """The different numbers of labels of the listed keys: a name has 127 at most."""
    return tuple(sorted(r[0] for r in listed.where("key is not null").select(F.size(F.split("key", r"\."))).distinct().collect()))


def key_universe(hosts: DataFrame, depths: tuple[int, ...]) -> DataFrame:
    """Every distinct domain with so many labels of the hosts in column ``host``."""
    labels = F.size(F.split("host", r"\."))
    keys = F.array(*(F.when(labels >= d, F.substring_index("host", ".", -d)) for d in depths)).cast("array<string>")
    return hosts.where("host <> ''").distinct().select(F.explode(keys).alias("key")).where("key <> ''").distinct()


def build_cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_FILTER_BYTES, max_levels: int = 64) -> Cascade:
    """listed, universe: one string column ``key``, distinct. The result is exact
    for every key of either."""
    inside = staged(listed.select("key").where("key is not null").distinct(), "cascade-listed")
    n_in = inside.count()
    if not n_in:
        return Cascade([])
    depths = label_depths(inside)
    outside = staged(universe.select("key").join(inside, "key", "left_anti"), "cascade-others")
    rate = min(0.5, n_in / (1.41 * max(1, outside.count())))
    levels: list[Level] = []
    for i in range(max_levels):
        levels.append(_build_level(inside, n_in, rate if not i else 0.5, i + 1, max_bytes))
        wrong = staged(_hits(outside, levels[-1]), "cascade-level")
        n_wrong = wrong.count()
        if not n_wrong:
            return Cascade(levels, depths)
        inside, outside, n_in = wrong, inside, n_wrong
    raise ValueError("the cascade does not end: the listed keys and the universe overlap")


def judge_urls(pages: DataFrame, listed: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages`` (page_id, url)."""
    spark = pages.sparkSession
    ship(spark)
    host, path = host_and_path(F.col("url"))
    cut = pages.select("page_id", host.alias("host"), path.alias("path"))
    cascade = spark.sparkContext.broadcast(build_cascade(listed, key_universe(cut.select("host"), label_depths(listed))))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = cascade.value
        for batch in batches:
            hosts = batch.column(batch.schema.get_field_index("host")).dictionary_encode()
            known = np.array([own.lists(h) for h in hosts.dictionary.to_pylist()], bool)
            codes = hosts.indices.to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(known[codes] if len(codes) else np.zeros(0, bool))], [*batch.schema.names, "listed"])

    judged = cut.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    id_type = cut.schema["page_id"].dataType.simpleString()
    return judged.mapInArrow(look_up, f"page_id {id_type}, host string, path string, rule string, by_rule string, listed boolean").select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed",
    )


def op1_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(h,) for h in LISTED_HOSTS], "key string")
    return judge_urls(table(spark, sf_dir, "pages"), listed)


def _sql() -> str:
    ordered = sorted(RULES, key=lambda r: (-len(r.text), -len(r.host)))
    fits = [(r, f"(host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')") for r in ordered]
    listed = " or ".join(f"host = '{h}' or ends_with(host, '.{h}')" for h in LISTED_HOSTS)
    return f"""
with a as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
b as (select page_id, rest, regexp_extract(rest, '^[^/?#]*', 0) as raw from a),
c as (select page_id, translate(raw, '{string.ascii_uppercase}', '{string.ascii_lowercase}') as host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*', 0) as path from b)
select page_id, host, path,
       case {" ".join(f"when {f} then '{r.text}'" for r, f in fits)} end as rule,
       case {" ".join(f"when {f} then '{r.verdict}'" for r, f in fits)} when {listed} then 'block' else 'allow' end as verdict,
       ({listed}) as listed
from c"""


OP1_SQL = _sql()
