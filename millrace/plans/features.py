"""Query cases: feature steps fitted and applied as table jobs."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml import feature as mf
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.registry import Tables, case

_KEYS = ["l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"]
_KEYS_SQL = ", ".join(_KEYS)


def cell(column: str, i: int, scale: int = 6) -> Column:
    """One slot of a vector column, rounded."""
    return F.round(vector_to_array(column)[i], scale)


def lines(t: Tables) -> DataFrame:
    """Two measures of every line as a vector."""
    df = t.lineitem.select(*_KEYS, "l_quantity", "l_extendedprice", "l_discount")
    return mf.VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="x").transform(df)


def points(t: Tables) -> DataFrame:
    """Embeddings as vectors."""
    return t.embeddings.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("x"))


def words(t: Tables) -> DataFrame:
    return mf.RegexTokenizer(inputCol="text", outputCol="w", pattern=r"[ \t\n\f\r]+").transform(t.documents.select("doc_id", "lang", "source", "text"))


@case("q_feature_bins", f"""
SELECT {_KEYS_SQL}, (l_quantity > 25)::DOUBLE AS flag, CASE WHEN l_quantity < 10 THEN 0.0 WHEN l_quantity < 30 THEN 1.0 ELSE 2.0 END::DOUBLE AS bin FROM lineitem""")
def feature_bins(t: Tables) -> DataFrame:
    flagged = mf.Binarizer(threshold=25.0, inputCol="l_quantity", outputCol="flag").transform(t.lineitem)
    cut = mf.Bucketizer(splits=[float("-inf"), 10.0, 30.0, float("inf")], inputCol="l_quantity", outputCol="bin")
    return cut.transform(flagged).select(*_KEYS, "flag", "bin")


@case("q_feature_quantile_bins", "SELECT count(*) AS n, 4::BIGINT AS bins, TRUE AS even FROM lineitem")
def feature_quantile_bins(t: Tables) -> DataFrame:
    fit = mf.QuantileDiscretizer(numBuckets=4, inputCol="l_extendedprice", outputCol="bin", relativeError=0.001).fit(t.lineitem)
    sizes = fit.transform(t.lineitem).groupBy("bin").agg(F.count("*").alias("c"))
    return sizes.agg(
        F.sum("c").alias("n"), F.count("*").alias("bins"), (F.max("c") - F.min("c") < 0.05 * F.sum("c")).alias("even")
    )


@case("q_feature_scalers", f"""
SELECT {_KEYS_SQL}, round((l_quantity - m) / s, 6) AS standard, round((l_quantity - lo) / (hi - lo), 6) AS min_max, round(l_quantity / greatest(abs(hi), abs(lo)), 6) AS max_abs
FROM lineitem, (SELECT avg(l_quantity) AS m, stddev_samp(l_quantity) AS s, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)""")
def feature_scalers(t: Tables) -> DataFrame:
    df = lines(t)
    for step in (
        mf.StandardScaler(inputCol="x", outputCol="a", withMean=True, withStd=True),
        mf.MinMaxScaler(inputCol="x", outputCol="b"), mf.MaxAbsScaler(inputCol="x", outputCol="c"),
    ):
        df = step.fit(df).transform(df)
    return df.select(*_KEYS, cell("a", 0).alias("standard"), cell("b", 0).alias("min_max"), cell("c", 0).alias("max_abs"))


@case("q_feature_robust_scaler", "SELECT count(*) AS n, TRUE AS centred, TRUE AS spread FROM lineitem")
def feature_robust_scaler(t: Tables) -> DataFrame:
    df = lines(t)
    out = mf.RobustScaler(inputCol="x", outputCol="a", withCentering=True).fit(df).transform(df)
    v = vector_to_array("a")[0]
    quarters = F.percentile_approx(v, [0.25, 0.5, 0.75], 10000)
    return out.agg(F.count("*").alias("n"), quarters.alias("q")).select(
        "n", (F.abs(F.col("q")[1]) < 0.1).alias("centred"), (F.abs(F.col("q")[2] - F.col("q")[0] - 1) < 0.1).alias("spread")
    )


@case("q_feature_vector_steps", f"""
SELECT {_KEYS_SQL}, round(l_quantity / sqrt(l_quantity * l_quantity + l_discount * l_discount), 6) AS normed, l_quantity * 2 AS weighted, l_discount AS sliced,
       round(l_quantity * l_discount, 6) AS poly, round(l_quantity * l_extendedprice, 2) AS crossed FROM lineitem""")
def feature_vector_steps(t: Tables) -> DataFrame:
    df = lines(t)
    price = mf.VectorAssembler(inputCols=["l_extendedprice"], outputCol="p")
    stages = [
        mf.VectorSizeHint(inputCol="x", size=2, handleInvalid="error"),
        mf.Normalizer(inputCol="x", outputCol="n", p=2.0),
        mf.ElementwiseProduct(inputCol="x", outputCol="e", scalingVec=Vectors.dense(2.0, 1.0)),
        mf.VectorSlicer(inputCol="x", outputCol="s", indices=[1]),
        mf.PolynomialExpansion(inputCol="x", outputCol="q", degree=2),
        price, mf.Interaction(inputCols=["l_quantity", "p"], outputCol="c"),
    ]
    out = Pipeline(stages=stages).fit(df).transform(df)
    # the expansion of (a, b) to degree two is (a, a*a, b, a*b, b*b)
    return out.select(
        *_KEYS, cell("n", 0).alias("normed"), cell("e", 0).alias("weighted"), cell("s", 0).alias("sliced"), cell("q", 3).alias("poly"),
        cell("c", 0, 2).alias("crossed"),
    )


@case("q_feature_dct", "SELECT vec_id, TRUE AS length_kept FROM embeddings")
def feature_dct(t: Tables) -> DataFrame:
    """The transform keeps a vector's length."""
    out = mf.DCT(inputCol="x", outputCol="y").transform(points(t))

    def square(c: str) -> Column:
        return F.aggregate(vector_to_array(c), F.lit(0.0), lambda acc, v: acc + v * v)

    return out.select("vec_id", (F.abs(square("x") - square("y")) < 1e-9).alias("length_kept"))


_WORDS = r"(SELECT doc_id, list_filter(string_split_regex(lower(text), '[ \t\n\f\r]+'), lambda w: w <> '') AS w FROM documents)"


@case("q_feature_tokens", f"""
SELECT doc_id, len(w)::INTEGER AS words, len(list_filter(w, lambda x: x NOT IN ('the', 'and')))::INTEGER AS kept, greatest(len(w) - 1, 0)::INTEGER AS pairs FROM {_WORDS}""")
def feature_tokens(t: Tables) -> DataFrame:
    df = mf.StopWordsRemover(inputCol="w", outputCol="k", stopWords=["the", "and"]).transform(words(t))
    df = mf.NGram(n=2, inputCol="w", outputCol="g").transform(df)
    return df.select("doc_id", F.size("w").alias("words"), F.size("k").alias("kept"), F.size("g").alias("pairs"))


@case("q_feature_tokenizer", "SELECT p_partkey, split_part(lower(p_name), ' ', 2) AS second FROM part")
def feature_tokenizer(t: Tables) -> DataFrame:
    out = mf.Tokenizer(inputCol="p_name", outputCol="w").transform(t.part)
    return out.select("p_partkey", F.col("w")[1].alias("second"))


@case("q_feature_term_counts", f"""
SELECT doc_id, len(w)::DOUBLE AS hashed, 3::DOUBLE AS counted FROM {_WORDS}""")
def feature_term_counts(t: Tables) -> DataFrame:
    """Counts over all slots add up to the words given, however they share slots."""
    df = words(t).select("doc_id", "w", F.array("lang", "source", "lang").alias("marks"))
    df = mf.HashingTF(inputCol="w", outputCol="h", numFeatures=1 << 10).transform(df)
    df = mf.CountVectorizer(inputCol="marks", outputCol="c", vocabSize=1 << 10).fit(df).transform(df)

    def total(c: str) -> Column:
        return F.aggregate(vector_to_array(c), F.lit(0.0), lambda acc, v: acc + v)

    return df.select("doc_id", total("h").alias("hashed"), total("c").alias("counted"))


@case("q_feature_idf", """
SELECT lang, round(ln((n + 1.0) / (df + 1.0)), 6) AS idf FROM (SELECT lang, count(*) AS df, (SELECT count(*) FROM documents) AS n FROM documents GROUP BY 1)""")
def feature_idf(t: Tables) -> DataFrame:
    """Inverse document frequency of the language mark, as one word per document."""
    df = t.documents.select("lang", F.array("lang").alias("w"))
    counts = mf.CountVectorizer(inputCol="w", outputCol="c").fit(df)
    out = mf.IDF(inputCol="c", outputCol="y").fit(counts.transform(df)).transform(counts.transform(df))
    value = F.array_max(vector_to_array("y"))
    return out.groupBy("lang").agg(F.round(F.max(value), 6).alias("idf"))


@case("q_feature_indexers", """
WITH ranks AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS r FROM orders GROUP BY 1)
SELECT o_orderkey, r::DOUBLE AS idx, o_orderpriority AS back, (r = 0)::INTEGER::DOUBLE AS first_slot FROM orders JOIN ranks USING (o_orderpriority)""")
def feature_indexers(t: Tables) -> DataFrame:
    fit = mf.StringIndexer(inputCol="o_orderpriority", outputCol="idx", stringOrderType="frequencyDesc").fit(t.orders)
    df = fit.transform(t.orders)
    df = mf.IndexToString(inputCol="idx", outputCol="back", labels=fit.labels).transform(df)
    df = mf.OneHotEncoder(inputCol="idx", outputCol="hot").fit(df).transform(df)
    return df.select("o_orderkey", "idx", "back", cell("hot", 0).alias("first_slot"))


@case("q_feature_imputer", """
WITH g AS (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS v, CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_nationkey AS DOUBLE) END AS m FROM customer)
SELECT c_custkey, round(coalesce(v, (SELECT avg(v) FROM g)), 6) AS mean_, coalesce(m, (SELECT m FROM g WHERE m IS NOT NULL GROUP BY m ORDER BY count(*) DESC, m LIMIT 1)) AS mode_ FROM g""")
def feature_imputer(t: Tables) -> DataFrame:
    gap = F.col("c_custkey") % 3 != 0
    df = t.customer.select("c_custkey", F.when(gap, F.col("c_acctbal")).alias("v"), F.when(gap, F.col("c_nationkey").cast("double")).alias("m"))
    a = mf.Imputer(strategy="mean", inputCols=["v"], outputCols=["mean_"]).fit(df).transform(df)
    b = mf.Imputer(strategy="mode", inputCols=["m"], outputCols=["mode_"]).fit(df).transform(a)
    return b.select("c_custkey", F.round("mean_", 6).alias("mean_"), "mode_")


@case("q_feature_hasher", "SELECT o_orderkey, round(o_totalprice + 1.0, 2) AS total FROM orders")
def feature_hasher(t: Tables) -> DataFrame:
    """A number keeps its value in its slot and a text sets one slot to 1, so the slots add up."""
    out = mf.FeatureHasher(inputCols=["o_totalprice", "o_orderstatus"], outputCol="h", numFeatures=64).transform(t.orders)
    total = F.aggregate(vector_to_array("h"), F.lit(0.0), lambda acc, v: acc + v)
    return out.select("o_orderkey", F.round(total, 2).alias("total"))


@case("q_feature_vector_indexer", f"""
SELECT {_KEYS_SQL}, (dense_rank() OVER (ORDER BY l_linenumber) - 1)::DOUBLE AS code FROM lineitem""")
def feature_vector_indexer(t: Tables) -> DataFrame:
    df = mf.VectorAssembler(inputCols=["l_linenumber", "l_extendedprice"], outputCol="x").transform(t.lineitem)
    out = mf.VectorIndexer(inputCol="x", outputCol="y", maxCategories=10).fit(df).transform(df)
    return out.select(*_KEYS, cell("y", 0).alias("code"))


@case("q_feature_formula_sql", "SELECT o_orderkey, o_totalprice / 1000 AS label, (o_orderstatus = 'F')::INTEGER::DOUBLE AS is_f, o_custkey % 7 AS digit FROM orders")
def feature_formula_sql(t: Tables) -> DataFrame:
    df = mf.SQLTransformer(statement="SELECT o_orderkey, o_custkey % 7 AS digit, o_totalprice / 1000 AS price, o_orderstatus = 'F' AS is_f FROM __THIS__").transform(t.orders)
    out = mf.RFormula(formula="price ~ is_f + digit").fit(df).transform(df)
    return out.select("o_orderkey", "label", cell("features", 0).alias("is_f"), "digit")


@case("q_feature_pca", "SELECT count(*) AS n, TRUE AS ordered_, TRUE AS bounded FROM embeddings")
def feature_pca(t: Tables) -> DataFrame:
    df = points(t)
    fit = mf.PCA(k=3, inputCol="x", outputCol="y").fit(df)
    v = vector_to_array("y")
    spread = fit.transform(df).agg(F.count("*").alias("n"), F.variance(v[0]).alias("a"), F.variance(v[1]).alias("b"))
    share = float(sum(fit.explainedVariance.toArray()))
    return spread.select("n", (F.col("a") >= F.col("b")).alias("ordered_"), F.lit(0 < share <= 1).alias("bounded"))


@case("q_feature_selectors", "SELECT count(*) AS n, 1::BIGINT AS chi, 2::BIGINT AS varied, 1::BIGINT AS best FROM lineitem")
def feature_selectors(t: Tables) -> DataFrame:
    """The copied label is the feature chosen; the constant one is dropped."""
    label = (F.col("l_linestatus") == "F").cast("double")
    df = t.lineitem.select(label.alias("label"), label.alias("same"), (F.col("l_linenumber") % 2).cast("double").alias("other"), F.lit(1.0).alias("const"))
    df = mf.VectorAssembler(inputCols=["other", "same", "const"], outputCol="x").transform(df)
    chi = mf.ChiSqSelector(numTopFeatures=1, featuresCol="x", labelCol="label").fit(df)
    varied = mf.VarianceThresholdSelector(featuresCol="x", varianceThreshold=0.0).fit(df)
    best = mf.UnivariateFeatureSelector(featuresCol="x", labelCol="label", selectionMode="numTopFeatures")
    best = best.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(1).fit(df)
    return df.agg(F.count("*").alias("n")).select(
        "n", F.lit(chi.selectedFeatures[0]).cast("bigint").alias("chi"), F.lit(len(varied.selectedFeatures)).cast("bigint").alias("varied"),
        F.lit(best.selectedFeatures[0]).cast("bigint").alias("best"),
    )


@case("q_feature_word2vec", "SELECT count(*) AS n, 8 AS width FROM benchmark")
def feature_word2vec(t: Tables) -> DataFrame:
    df = mf.Tokenizer(inputCol="text", outputCol="w").transform(t.benchmark)
    fit = mf.Word2Vec(vectorSize=8, minCount=2, maxIter=1, seed=1, inputCol="w", outputCol="v").fit(df)
    return fit.transform(df).agg(F.count("*").alias("n"), F.max(F.size(vector_to_array("v"))).alias("width"))


@case("q_feature_lsh_neighbours", "SELECT 5::BIGINT AS n, TRUE AS self_first, TRUE AS near FROM embeddings LIMIT 1")
def feature_lsh_neighbours(t: Tables) -> DataFrame:
    """Five approximate neighbours of one vector are closer than vectors are on average."""
    df = points(t)
    fit = mf.BucketedRandomProjectionLSH(inputCol="x", outputCol="h", bucketLength=2.0, numHashTables=4, seed=3).fit(df)
    key = df.orderBy("vec_id").select("x").first()[0]
    found = fit.approxNearestNeighbors(df, key, 5)
    mean = df.select(_distance(key).alias("d")).agg(F.avg("d").alias("mean"))  # one row
    stats = found.agg(F.count("*").alias("n"), F.min("distCol").alias("lo"), F.max("distCol").alias("hi"))
    return stats.crossJoin(mean).select("n", (F.col("lo") < 1e-9).alias("self_first"), (F.col("hi") < F.col("mean")).alias("near"))


def _distance(key) -> Column:
    at = F.array(*[F.lit(float(v)) for v in key])
    return F.sqrt(F.aggregate(F.zip_with(vector_to_array("x"), at, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v))


@case("q_feature_minhash_join", """
    WITH texts AS (SELECT min(doc_id) AS doc_id, text FROM documents WHERE text IS NOT NULL GROUP BY text),
    parts AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(lower(text), '\\s+') IF x <> ''] AS w FROM texts),
    shingles AS (
      SELECT DISTINCT doc_id, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) AS s
      FROM parts WHERE len(w) > 2),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (
      SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, count(*) AS n
      FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    found AS (
      SELECT doc_a, doc_b, 1 - s.n / (a.n + b.n - s.n) AS d
      FROM shared s JOIN sizes a ON doc_a = a.doc_id JOIN sizes b ON doc_b = b.doc_id)
    SELECT doc_a, doc_b, round(d, 9) AS distance FROM found WHERE d < 0.3""")
def feature_minhash_join(t: Tables) -> DataFrame:
    """Pairs of different texts that share over 0.7 of their three-word shingles, each once.

    Equal texts are one row first, so a much repeated text makes no pairs with itself. A
    shingle is a hash below 2e9, so there is no vocabulary to cut. A pair is missed by all
    16 tables with a chance of 0.3 ** 16.
    """
    texts = t.documents.where(F.col("text").isNotNull()).groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    words_ = mf.RegexTokenizer(inputCol="text", outputCol="w").transform(texts)
    shingles = mf.NGram(n=3, inputCol="w", outputCol="s").transform(words_).where(F.size("s") > 0)
    df = mf.HashingTF(inputCol="s", outputCol="h", binary=True, numFeatures=2_000_000_000).transform(shingles).select("doc_id", "h")
    fit = mf.MinHashLSH(inputCol="h", outputCol="m", numHashTables=16, seed=5).fit(df)
    pairs = fit.approxSimilarityJoin(df, df, 0.3, "d").where(F.col("datasetA.doc_id") < F.col("datasetB.doc_id"))
    return pairs.select(
        F.col("datasetA.doc_id").alias("doc_a"), F.col("datasetB.doc_id").alias("doc_b"), F.round("d", 9).alias("distance"))
