"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact hash join of its possible hits.

Built from DataFrame functions only.  A listed entry is a host and a path prefix; it fits its host, all subdomains
and every path that starts with the prefix, and the longest entry decides.

* **Canonical keys.**  An entry's key is ``host + path``.  A page asks for the suffixes of its host (at dots), each
  with the prefixes of its path; only the label counts and prefix lengths that occur in the list are asked for.
* **Blocked Bloom filter.**  A key's hash picks one block of four 64-bit words and two bits in each of them.  The
  filter has 16 bits or more per entry and never more than ``max_filter_bytes``, so it may always be sent to every
  task; a longer list makes it less selective, not larger and never wrong.
* **Exact join.**  Keys the filter lets through are joined with the list itself, which removes its false positives.
  The list is salted against keys that very many pages ask for, unless Spark finds it small enough to broadcast.

Results that are defined: a null URL or one without ``://`` has an empty host and path and no rule; among entries of
equal length the longer host wins, then ``block`` over ``allow``; entries with a null part are left out, repeated
ones count once; an empty list lets every page pass; repeated pages are judged alike and all returned; an empty table
gives an empty result.  Input columns named like a result column give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradewell.llm.common import field, let, lower_ascii, packed, stored, unpacked

BITS_PER_ENTRY = 16
WORDS_PER_BLOCK = 4
MAX_FILTER_BYTES = 4 << 20
#: Copies of the list when it is too large to broadcast; a hot key's pages go to as many tasks.
SALTS = 16


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and the path of a URL; empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def suffixes(host: Column, label_counts: list[int]) -> Column:
    """The last labels of a host, for every listed number of labels that it has."""
    return let(
        F.split(host, r"\."),
        lambda labels: F.transform(
            F.filter(F.array(*map(F.lit, label_counts)), lambda n: n <= F.size(labels)),
            lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."),
        ),
    )


def prefixes(path: Column, lengths: list[int]) -> Column:
    return F.transform(
        F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n)
    )


def _block(key_hash: Column, blocks: int) -> Column:
    return F.pmod(F.shiftrightunsigned(key_hash, 32), F.lit(blocks))


def _bits(key_hash: Column, word: int) -> Column:
    """Two bits of one word of the block, from different parts of a second hash."""
    second = F.xxhash64(F.lit(word), key_hash)
    one = F.lit(1).cast("bigint")
    low, high = F.pmod(second, F.lit(64)).cast("int"), F.pmod(F.shiftrightunsigned(second, 20), F.lit(64)).cast("int")
    return F.call_function("shiftleft", one, low).bitwiseOR(F.call_function("shiftleft", one, high))


def bloom_words(keys: DataFrame, blocks: int) -> DataFrame:
    """One row with the whole filter as one array of words; ``keys`` has the column ``hash``."""
    words = keys.groupBy(_block(F.col("hash"), blocks).alias("block")).agg(
        *(F.bit_or(_bits(F.col("hash"), k)).alias(f"w{k}") for k in range(WORDS_PER_BLOCK))
    )
    filled = words.agg(
        F.map_from_entries(F.collect_list(F.struct("block", F.array(*(f"w{k}" for k in range(WORDS_PER_BLOCK))))))
        .alias("found")
    )
    empty = F.array_repeat(F.lit(0).cast("bigint"), WORDS_PER_BLOCK)
    every = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: F.coalesce(F.col("found")[b.cast("bigint")], empty))
    return filled.select(F.flatten(every).alias("words"))


def might_contain(words: Column, key_hash: Column, blocks: int) -> Column:
    first = _block(key_hash, blocks) * WORDS_PER_BLOCK
    hit = None
    for k in range(WORDS_PER_BLOCK):
        bits = _bits(key_hash, k)
        same = F.element_at(words, (first + (k + 1)).cast("int")).bitwiseAND(bits) == bits
        hit = same if hit is None else hit & same
    return hit


def canonical(rules: DataFrame) -> DataFrame:
    """The list with its keys: one row per key, ``block`` before ``allow``."""
    listed = rules.filter("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").select(
        lower_ascii(F.col("host")).alias("host"), "path", "verdict"
    )
    return (
        listed.groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("hash", F.xxhash64("host", "path"))
    )


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """The input columns and host, path, ``rule`` (host and path of the entry that decides) and ``verdict``.

    ``rules`` has verdict (allow or block), host and path.  Pages that no entry fits are allowed.
    """
    listed = stored(canonical(rules), "url-list")
    n, labels, lengths = listed.agg(
        F.count("*"), F.collect_set(F.size(F.split("host", r"\."))), F.collect_set(F.length("path"))
    ).first()
    host, path = host_and_path(field(url))
    parts = packed(pages).withColumns({"host": host, "path": path})
    if n == 0:
        free = parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
        return unpacked(free, "host", "path", "rule", "verdict")

    block_bytes = 8 * WORDS_PER_BLOCK
    blocks = max(1, min(max_filter_bytes, n * BITS_PER_ENTRY // 8) // block_bytes)
    words = bloom_words(listed, blocks).scalar()
    pairs = F.flatten(
        F.transform(
            suffixes(F.col("host"), sorted(labels)),
            lambda h: F.transform(
                prefixes(F.col("path"), sorted(lengths)),
                lambda p: F.struct(h.alias("host"), p.alias("path"), F.xxhash64(h, p).alias("hash")),
            ),
        )
    )
    asked = parts.withColumn("asked", pairs).withColumn("words", words)
    possible = asked.withColumn(
        "asked", F.filter("asked", lambda a: might_contain(F.col("words"), a["hash"], blocks))
    ).drop("words")

    clean = possible.filter(F.size("asked") == 0).select(
        "row", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict")
    )
    exact = listed.select(
        F.col("host").alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("r_salt"),
    )
    hits = (
        possible.filter(F.size("asked") > 0)
        .withColumn("page", F.monotonically_increasing_id())
        .withColumn("ask", F.explode("asked"))
        .withColumn("salt", F.pmod("page", F.lit(SALTS)).cast("int"))
    )
    found = hits.join(
        exact,
        (F.col("ask.host") == F.col("r_host")) & (F.col("ask.path") == F.col("r_path")) & (F.col("salt") == F.col("r_salt")),
        "left",
    )
    rule = F.concat("r_host", "r_path")
    best = F.max(
        F.when(F.col("r_host").isNotNull(), F.struct(F.length(rule), F.length("r_host"), "r_verdict", rule.alias("rule")))
    )
    decided = (
        found.groupBy("page")
        .agg(F.first("row").alias("row"), F.first("host").alias("host"), F.first("path").alias("path"), best.alias("best"))
        .select("row", "host", "path", "best.rule", F.coalesce("best.r_verdict", F.lit("allow")).alias("verdict"))
    )
    return unpacked(clean.unionByName(decided), "host", "path", "rule", "verdict")
