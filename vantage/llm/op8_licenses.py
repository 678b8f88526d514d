"""License scans [native]: MinHash bands over overlapping windows retrieve templates, containment verifies them.

Only DataFrame expressions are used. A template of t words is looked for in
windows of t + t // 4 words that start every t // 4 + 1 words, so that any t
consecutive words lie inside some window; a window that holds the whole
template has a shingle similarity of 0.5 or more with it (more for longer
templates). `BANDS` bands of one minimum each collide with a chance of
1 - (1 - J) ** BANDS: at J = 0.5 and 24 bands all but 6e-8 of such windows
retrieve their template. A match is a window that holds at least `threshold`
of the template's shingles (5 words; all words of a shorter template).

A window can only match if it holds `threshold` of the template's shingles, so
it holds at least one of any set of them that is larger than the rest. Such a
set is marked by a few key words (long ones, as they are rarer): texts with
none of the key words are passed over before they are cut into words, and so
are windows with none; nothing that could match is lost.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.llm.license_texts import TEMPLATES

K = 5
BANDS = 24
BROADCAST_BYTES = 32 << 20  # of banded templates


def plain_words(text: str) -> list[str]:
    """The words that `words_of` finds in a template (templates are ASCII)."""
    return re.findall(r"[a-z0-9]+", text.lower())


def words_of(text: Column) -> Column:
    """Runs of letters and digits of a text in lower case."""
    spaced = F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def key_words(templates: dict[str, str], threshold: float) -> list[str]:
    """Words such that more than 1 - threshold of each template's shingles hold one; long words first."""
    out: set[str] = set()
    for text in templates.values():
        w = plain_words(text)
        k = min(K, len(w))
        runs = [set(w[i:i + k]) for i in range(len(w) - k + 1)]
        while sum(bool(r & out) for r in runs) <= (1 - threshold) * len(runs) + 1e-9:
            free = [r for r in runs if not r & out]
            out.add(min(set().union(*free), key=lambda x: (-len(x), -sum(x in r for r in free), x)))
    return sorted(out)


def shingle_hashes(words: Column, k: int) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)),
                                        lambda i: F.xxhash64(F.array_join(F.slice(words, i, k), " "))))


def banded(rows: DataFrame, hashes: str) -> DataFrame:
    """One row for each band: `band`, and in `least` the least of the band's hashes of the shingle hashes."""
    every = rows.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))))
    return every.withColumn("least", F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.col("band")))))


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """size (words), license_id and need (shingle hashes) of each template."""
    rows = [(len(plain_words(t)), name, plain_words(t)) for name, t in templates.items()]
    table = spark.createDataFrame(rows, "size int, license_id string, words array<string>")
    need = F.when(F.col("size") < K, F.array(F.xxhash64(F.array_join("words", " ")))).otherwise(
        shingle_hashes(F.col("words"), K))
    return table.select("size", "license_id", need.alias("need"))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = 0.8) -> DataFrame:
    """doc_id, license_id, containment, start_word, n_windows: the best window of each template in each document.

    Null and empty texts match nothing, nor do rows of an empty table. Rows
    that share a doc_id are reported together. Ties go to the first window.
    Only doc_id and text are read."""
    templates = TEMPLATES if templates is None else templates
    templates = {name: t for name, t in templates.items() if plain_words(t)}
    known = template_table(docs.sparkSession, templates)
    may, keyed = F.lit(False), key_words(templates, threshold)
    for word in keyed:
        may = may | F.col("lower").contains(word)
    # generators of one element keep the optimizer from repeating an expression for every word that is looked for
    rows = (docs.select("doc_id", F.explode(F.array(F.lower("text"))).alias("lower")).where(may)
            .select("doc_id", F.explode(F.array(words_of(F.col("lower")))).alias("words")))
    # one entry for each template length: window length and step
    sizes = sorted({len(plain_words(t)) for t in templates.values()})
    if not sizes:
        return docs.sparkSession.createDataFrame([], "doc_id long, license_id string, containment double, "
                                                     "start_word int, n_windows long")
    shapes = F.explode(F.array(*[F.struct(F.lit(t).alias("size"), F.lit(t + t // 4).alias("width"),
                                          F.lit(t // 4 + 1).alias("step")) for t in sizes])).alias("shape")
    spots = F.filter(F.sequence(F.lit(0), F.size("words") - 1),
                     lambda i: F.get("words", i).isin(keyed))  # where the key words stand
    shaped = (rows.where(F.size("words") > 0).select("doc_id", "words", F.explode(F.array(spots)).alias("spots"))
              .select("doc_id", "words", "spots", shapes)
              .select("doc_id", "words", "spots", "shape.*").where(F.size("words") >= F.col("size")))

    def around(i: Column) -> Column:
        """Starts of the windows that hold word i; a window starts where a template could still begin."""
        low = F.greatest(F.lit(0), F.floor((i - F.col("width") + F.col("step")) / F.col("step")) * F.col("step"))
        high = F.floor(F.least(i, F.size("words") - F.col("size")) / F.col("step")) * F.col("step")
        return F.when(low <= high, F.sequence(low, high, F.col("step").cast("long"))).otherwise(
            F.array().cast("array<bigint>"))

    starts = F.array_distinct(F.flatten(F.transform("spots", around)))
    windows = shaped.select("doc_id", "size", "width", "words", F.explode(starts.cast("array<int>")).alias("start")).select(
        "doc_id", "size", "start", F.slice("words", F.col("start") + 1, F.col("width")).alias("w"))
    own = F.when(F.col("size") < K, _runs(F.col("w"), sizes)).otherwise(shingle_hashes(F.col("w"), K))
    hashed = banded(windows.select("doc_id", "size", "start", own.alias("held")), "held")
    keys = banded(known, "need")
    share = F.size(F.array_intersect("need", "held")) / F.size("need")
    # an argument of checked size goes to every executor; a larger one meets the windows in a shuffle
    held_bytes = sum(BANDS * (8 * len(plain_words(t)) + len(name) + 64) for name, t in templates.items())
    keys = F.broadcast(keys) if held_bytes <= BROADCAST_BYTES else keys.hint("merge")
    met = hashed.join(keys, ["size", "band", "least"]).select("doc_id", "license_id", "start", share.alias("share"))
    return (met.where(F.col("share") >= threshold).groupBy("doc_id", "license_id")
            .agg(F.max(F.struct("share", -F.col("start"))).alias("best"), F.count_distinct("start").alias("n_windows"))
            .select("doc_id", "license_id", F.col("best.share").alias("containment"),
                    (-F.col("best.col2")).alias("start_word"), "n_windows"))


def _runs(words: Column, sizes: list[int]) -> Column:
    """Hashes of the runs of `size` words, for sizes below K."""
    out = F.array().cast("array<bigint>")
    for t in sizes:
        if t < K:
            out = F.when(F.col("size") == t, shingle_hashes(words, t)).otherwise(out)
    return out


def oracle(templates: dict[str, str] | None = None, threshold: float = 0.8) -> str:
    """DuckDB SQL of `scan` over all texts: every shingle of a text that a template has, and the windows that hold it.
    It knows neither key words nor bands."""
    templates = TEMPLATES if templates is None else templates
    rows = ", ".join(f"('{name}', {plain_words(t)})" for name, t in templates.items())
    return f"""
WITH t(license_id, words) AS (VALUES {rows}),
tk AS (SELECT license_id, len(words) AS size, least(len(words), {K}) AS k, words FROM t),
tg AS (SELECT license_id, size, k, list_distinct(list_transform(range(1, size - k + 2),
         lambda i: array_to_string(words[i:i + k - 1], ' '))) AS need FROM tk),
ts AS (SELECT license_id, size, k, size + size // 4 AS width, size // 4 + 1 AS step, len(need) AS needed,
              unnest(need) AS shingle FROM tg),
w AS (SELECT doc_id, row_number() OVER () AS r, list_filter(string_split(
         regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS words FROM documents),
runs AS (SELECT doc_id, r, words, len(words) AS n, k, unnest(range(0, len(words) - k + 1)) AS p
       FROM w, (SELECT DISTINCT k FROM tk) WHERE len(words) >= k),
hit AS (SELECT doc_id, r, n, p, k, license_id, size, width, step, needed, shingle
        FROM (SELECT doc_id, r, n, p, k, array_to_string(words[p + 1:p + k], ' ') AS shingle FROM runs)
        JOIN ts USING (k, shingle) WHERE n >= size),
win AS (SELECT doc_id, r, license_id, needed, shingle, unnest(range(
          greatest(0, CAST(ceil((p + k - width) / step) AS BIGINT)) * step, least(p, n - size) + 1, step)) AS start FROM hit),
held AS (SELECT doc_id, r, license_id, start, count(DISTINCT shingle) / any_value(needed) AS share FROM win GROUP BY ALL),
ok AS (SELECT * FROM held WHERE share >= {threshold})
SELECT doc_id, license_id, max(share) AS containment,
       CAST(arg_min(start, (-share, start)) AS INTEGER) AS start_word, count(DISTINCT start) AS n_windows
FROM ok GROUP BY doc_id, license_id
"""
