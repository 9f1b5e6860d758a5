"""URL filters: rules by host and path, and boosted trees over the look of a URL for the rest.

* A rule is a host with a path; it fits the host and all its subdomains where the URL's path
  starts with the rule's. Of rules that fit the longest wins. Rules are a short list, written
  into the plan as conditions.
* Labelled URLs (by default those that rules judge) train gradient-boosted trees on `SAMPLE`
  of them at most, the smallest by hash. Features: lengths, depth, ratio of digits and capitals,
  entropy of signs, signs of the host, parameters, and statistics of the host's suffixes.
* Suffix statistics are counted over all URLs and all labels: how often a suffix of one and
  of two names is there, and the share of its labelled URLs that are blocked, drawn to the
  share of all by `PRIOR`. Labelled URLs are dealt in `FOLDS` by host; the share that one sees
  is that of the other folds, so its own label doesn't show in its features.
* Hot suffixes: those of at least 1 / `HEAVY` of all URLs, at most `HEAVY`, are sent to all
  tasks; the rest, none of which is large, are joined by a shuffle.

Nulls: a null URL counts as empty. A URL without `://` has an empty host and path. Rows that
repeat a page_id or URL are judged alike. With labels of one kind only that is the verdict for
the rest, and without any it is `allow`. An empty table gives no rows; further columns are not
read. The entropy of a very long URL is over all its signs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import written

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SAMPLE = 20_000
TREES, DEPTH, SHRINK = 20, 4, 0.2
FOLDS = 5
PRIOR = 20.0
HEAVY = 1000
SEED = 17
FEATURES = ("url_length", "host_length", "path_length", "query_length", "depth", "digits", "capitals", "escapes", "entropy", "names", "longest_name",
            "host_digits", "hyphens", "params", "longest_param", "secure", "suffix1_seen", "suffix1_blocked", "suffix2_seen", "suffix2_blocked")


def parts(pages: DataFrame) -> DataFrame:
    """`pages` (page_id, url) with host, path and query."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rows = pages.select("page_id", url.alias("url"), rest.alias("rest"))
    host = F.regexp_extract("rest", r"^[^/?#]*", 0)
    rows = rows.withColumn("raw_host", host).withColumn("behind", F.col("rest").substr(F.length("raw_host") + 1, F.length("rest")))
    lower = F.translate("raw_host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return rows.select("page_id", "url", lower.alias("host"), F.regexp_extract("behind", r"^[^?#]*", 0).alias("path"),
                       F.regexp_extract("behind", r"^[^?#]*\?([^#]*)", 1).alias("query"))


def ruled(rows: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """`rows` (host, path) with rule and what it says; null where none fits."""
    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))

    def pick(value) -> Column:
        found = None
        for says, host, path in longest_first:
            fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))) & F.startswith(F.col("path"), F.lit(path))
            found = F.when(fits, value(says, host, path)) if found is None else found.when(fits, value(says, host, path))
        return F.lit(None).cast("string") if found is None else found

    return rows.withColumn("rule", pick(lambda says, host, path: F.lit(host + path))).withColumn("says", pick(lambda says, host, path: F.lit(says)))


def _share(column: str, pattern: str) -> Column:
    return F.regexp_count(column, F.lit(pattern)) / F.greatest(F.length(column), F.lit(1))


def _entropy(column: str) -> Column:
    n = F.greatest(F.length(column), F.lit(1)).cast("double")
    share = lambda sign: (F.length(column) - F.length(F.replace(F.col(column), sign))) / n
    signs = F.filter(F.array_distinct(F.split(column, "")), lambda s: F.length(s) > 0)
    return F.aggregate(F.transform(signs, share), F.lit(0.0), lambda sum_, p: sum_ - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def lexical(rows: DataFrame) -> DataFrame:
    """`rows` of `parts` with the features that need no other row, and the suffixes of the host."""
    longest = lambda column, sign: F.coalesce(F.array_max(F.transform(F.split(column, sign), F.length)), F.lit(0))
    return rows.select(
        "*", F.length("url").alias("url_length"), F.length("host").alias("host_length"), F.length("path").alias("path_length"), F.length("query").alias("query_length"),
        F.regexp_count("path", F.lit("/")).alias("depth"), _share("url", "[0-9]").alias("digits"), _share("url", "[A-Z]").alias("capitals"),
        F.regexp_count("url", F.lit("%[0-9A-Fa-f]{2}")).alias("escapes"), _entropy("url").alias("entropy"), F.regexp_count("host", F.lit(r"\.")).alias("names"),
        longest("host", r"\.").alias("longest_name"), _share("host", "[0-9]").alias("host_digits"), F.regexp_count("host", F.lit("-")).alias("hyphens"),
        F.when(F.col("query") == "", 0).otherwise(F.regexp_count("query", F.lit("[&;]")) + 1).alias("params"), longest("query", "[&;]").alias("longest_param"),
        F.startswith(F.col("url"), F.lit("https:")).cast("int").alias("secure"),
        F.substring_index("host", ".", -1).alias("suffix1"), F.substring_index("host", ".", -2).alias("suffix2"))


def _with_suffixes(rows: DataFrame, level: int) -> DataFrame:
    """`rows` with the statistics of the suffix of `level` names; `blocked` is 1, 0 or null."""
    key, fold = f"suffix{level}", F.pmod(F.xxhash64("host"), F.lit(FOLDS))
    # sums by fold in one row per suffix
    by_fold = rows.withColumn("fold", fold).groupBy(F.col(key).alias("suffix")).agg(
        F.count("*").alias("seen"),
        F.array(*[F.count_if((F.col("fold") == f) & F.col("blocked").isNotNull()) for f in range(FOLDS)]).alias("labelled"),
        F.array(*[F.coalesce(F.sum(F.when(F.col("fold") == f, F.col("blocked"))), F.lit(0)) for f in range(FOLDS)]).alias("blocks"))
    stats = written(by_fold, "suffixes")
    total = lambda column: F.aggregate(column, F.lit(0).cast("bigint"), lambda a, b: a + b)
    n, labelled, blocks = stats.agg(F.sum("seen"), F.sum(total("labelled")), F.sum(total("blocks"))).first()
    n, prior = n or 0, (blocks or 0) / labelled if labelled else 0.5
    heavy = F.col("seen") >= max(n / HEAVY, 1)
    own = lambda column: F.when(F.col("blocked").isNull(), F.lit(0)).otherwise(F.get(column, fold.cast("int")))
    blocked = (total(F.col("blocks")) - own("blocks") + PRIOR * prior) / (total(F.col("labelled")) - own("labelled") + PRIOR)

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, F.col(key) == F.col("suffix"), "left")

    # at most HEAVY rows have such a share of all
    first = joined(rows, F.broadcast(stats.where(heavy)))
    light = joined(first.where("suffix IS NULL").drop("suffix", "seen", "labelled", "blocks"), stats.where(~heavy).hint("merge"))
    both = first.where("suffix IS NOT NULL").unionByName(light)
    return (both.withColumn(f"{key}_seen", F.log(F.coalesce("seen", F.lit(0)) + 1) - F.log(F.lit(float(n + 1)))).withColumn(f"{key}_blocked", blocked)
            .drop("suffix", "seen", "labelled", "blocks"))


def features(rows: DataFrame) -> DataFrame:
    """`rows` of `parts` with `blocked`, and all of FEATURES."""
    return _with_suffixes(_with_suffixes(lexical(rows), 1), 2)


def train(rows: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH):
    """Boosted trees fitted on at most `sample` labelled rows of `features`."""
    some = rows.where("blocked IS NOT NULL").select("blocked", *FEATURES, F.xxhash64("url", "page_id").alias("h")).orderBy("h", *FEATURES).limit(sample)
    some = written(some.repartition(4, "h").sortWithinPartitions("h", *FEATURES), "labelled")
    model = GBTClassifier(labelCol="blocked", featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=SHRINK, seed=SEED, minInstancesPerNode=5)
    return model.fit(assembled(some))


def assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, labels: DataFrame | None = None, **options) -> DataFrame:
    """page_id, host, path, rule, verdict and score (the trees' chance of `block`; null where a rule decides) for every row of `pages`.

    `labels` (label_id, blocked: 0 or 1) trains the trees, one row per page_id; without it the rules' verdicts do.
    """
    rows = ruled(parts(pages), rules)
    if labels is None:
        rows = rows.withColumn("blocked", F.when(F.col("says").isNotNull(), (F.col("says") == "block").cast("int")))
    else:
        given = labels.where("label_id IS NOT NULL").groupBy("label_id").agg(F.max(F.col("blocked").cast("int")).alias("blocked"))
        rows = rows.join(given, F.col("page_id") == F.col("label_id"), "left").drop("label_id")
    known = written(features(rows), "features")
    kinds = [r[0] for r in known.where("blocked IS NOT NULL").select("blocked").distinct().collect()]  # two at most
    if len(kinds) < 2:
        scored = known.withColumn("score", F.lit(float(kinds[0]) if kinds else 0.0))
    else:
        asked = assembled(known.where("says IS NULL"))
        chance = vector_to_array("probability")[1]
        judged = train(known, **options).transform(asked).withColumn("score", chance)
        scored = judged.select(*known.columns, "score").unionByName(known.where("says IS NOT NULL").withColumn("score", F.lit(None).cast("double")))
    score = F.when(F.col("says").isNull(), F.col("score"))
    verdict = F.coalesce("says", F.when(F.col("score") > 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), score.alias("score"))
