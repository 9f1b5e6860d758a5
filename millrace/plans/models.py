"""Query cases: models, tests, evaluation and matrices as table jobs.

A fit is not the same in two engines, so most cases give facts any right fit has (all
rows scored, better than the plain guess); closed-form ones are compared in full.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as mc
from pyspark.ml import clustering as ml_clusters
from pyspark.ml import evaluation as me
from pyspark.ml import feature as mf
from pyspark.ml import fpm, recommendation, stat, tuning
from pyspark.ml import regression as mr
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import matrix
from millrace.operators.ranks import rank_correlation
from millrace.plans.registry import Tables, case
from millrace.sources.scratch import scratch
from millrace.streaming.learning import CentroidModel, GradientModel, ModelLog, train
from millrace.streaming.sinks import finish
from millrace.streaming.sources import file_stream, table_stream


def points(t: Tables, classes: int = 2) -> DataFrame:
    """Embeddings as feature vectors, their label folded to a few classes."""
    x = array_to_vector(F.col("embedding").cast("array<double>"))
    return t.embeddings.select("vec_id", (F.floor(F.col("label") * classes / 10)).cast("double").alias("label"), x.alias("features"))


def flat_lines(t: Tables) -> DataFrame:
    """Line price from quantity and discount."""
    df = t.lineitem.select("l_orderkey", "l_quantity", "l_discount", F.col("l_extendedprice").alias("label"))
    return mf.VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features").transform(df)


def _better_class(scored: DataFrame) -> DataFrame:
    """All rows scored, and more hits than always naming the commonest class."""
    per = scored.groupBy("label").agg(F.count("*").alias("c"), F.count_if(F.col("prediction") == F.col("label")).alias("hit"))
    return per.agg(F.sum("c").alias("n"), (F.sum("hit") > F.max("c")).alias("better"))


def _better_number(scored: DataFrame, label: str = "label") -> DataFrame:
    """All rows scored, and a smaller squared error than always naming the mean."""
    gap = F.avg(F.pow(F.col("prediction") - F.col(label), 2))
    return scored.agg(F.count("prediction").alias("n"), (gap < F.var_pop(label)).alias("better"))


def _add_classifier(name: str, estimator, classes: int = 2) -> None:
    @case(name, "SELECT count(*) AS n, TRUE AS better FROM embeddings")
    def build(t: Tables) -> DataFrame:
        df = points(t, classes)
        return _better_class(estimator().fit(df).transform(df))


_add_classifier("q_model_logistic", lambda: mc.LogisticRegression(maxIter=20, regParam=0.01))
_add_classifier("q_model_logistic_multinomial", lambda: mc.LogisticRegression(maxIter=20, family="multinomial"), 5)
_add_classifier("q_model_linear_svc", lambda: mc.LinearSVC(maxIter=20, regParam=0.01))
_add_classifier("q_model_tree_classifier", lambda: mc.DecisionTreeClassifier(maxDepth=5, seed=1))
_add_classifier("q_model_forest_classifier", lambda: mc.RandomForestClassifier(numTrees=10, maxDepth=5, seed=1))
_add_classifier("q_model_gbt_classifier", lambda: mc.GBTClassifier(maxIter=4, maxDepth=3, seed=1))
_add_classifier("q_model_naive_bayes", lambda: mc.NaiveBayes(modelType="gaussian"), 5)
_add_classifier("q_model_perceptron", lambda: mc.MultilayerPerceptronClassifier(layers=[64, 8, 2], maxIter=30, seed=1))
_add_classifier("q_model_one_vs_rest", lambda: mc.OneVsRest(classifier=mc.LogisticRegression(maxIter=10)), 3)
_add_classifier("q_model_fm_classifier", lambda: mc.FMClassifier(factorSize=2, maxIter=30, stepSize=0.1, seed=1))


FIT_ROWS = 1 << 20  # rows of a partition that a tree model caches and reads again on every pass


def bounded(df: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """All rows of `df`, dealt so that no partition holds more than about `rows`, however large the table."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(parts)


def _add_regressor(name: str, estimator) -> None:
    @case(name, "SELECT count(*) AS n, TRUE AS better FROM lineitem")
    def build(t: Tables) -> DataFrame:
        df = bounded(flat_lines(t))
        return _better_number(estimator().fit(df).transform(df))


_add_regressor("q_model_tree_regressor", lambda: mr.DecisionTreeRegressor(maxDepth=4, seed=1))
_add_regressor("q_model_forest_regressor", lambda: mr.RandomForestRegressor(numTrees=5, maxDepth=4, seed=1))
_add_regressor("q_model_gbt_regressor", lambda: mr.GBTRegressor(maxIter=3, maxDepth=3, seed=1))
_add_regressor("q_model_glm", lambda: mr.GeneralizedLinearRegression(family="gaussian", link="identity", maxIter=5))
_add_regressor("q_model_isotonic", lambda: mr.IsotonicRegression(featureIndex=0))


@case("q_model_linear_regression", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem""")
def model_linear_regression(t: Tables) -> DataFrame:
    df = t.lineitem.select(F.col("l_extendedprice").alias("label"), "l_quantity")
    df = mf.VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(df)
    fit = mr.LinearRegression(solver="normal").fit(df)
    return t.spark.createDataFrame([(float(fit.coefficients[0]), float(fit.intercept))], "slope double, intercept double").select(
        F.round("slope", 3).alias("slope"), F.round("intercept", 2).alias("intercept")
    )


@case("q_model_elastic_net", "SELECT count(*) AS n, TRUE AS better, TRUE AS shrunk FROM lineitem")
def model_elastic_net(t: Tables) -> DataFrame:
    """Lasso and ridge weights are smaller than the plain ones."""
    df = flat_lines(t)
    plain = mr.LinearRegression(regParam=0.0).fit(df)
    ridge = mr.LinearRegression(regParam=500.0, elasticNetParam=0.0).fit(df)
    lasso = mr.LinearRegression(regParam=500.0, elasticNetParam=1.0).fit(df)
    size = [sum(abs(v) for v in m.coefficients) for m in (plain, ridge, lasso)]
    return _better_number(ridge.transform(df)).withColumn("shrunk", F.lit(size[1] < size[0] and size[2] < size[0]))


@case("q_model_survival", "SELECT count(*) AS n, TRUE AS positive FROM lineitem")
def model_survival(t: Tables) -> DataFrame:
    censor = (F.col("l_linestatus") == "F").cast("double")
    df = t.lineitem.select((F.col("l_quantity") + 1).alias("label"), censor.alias("censor"), "l_discount")
    df = mf.VectorAssembler(inputCols=["l_discount"], outputCol="features").transform(df)
    fit = mr.AFTSurvivalRegression(maxIter=10).fit(df)
    return fit.transform(df).agg(F.count("*").alias("n"), (F.min("prediction") > 0).alias("positive"))


@case("q_model_fm_regressor", "SELECT count(*) AS n, TRUE AS finite FROM lineitem")
def model_fm_regressor(t: Tables) -> DataFrame:
    df = flat_lines(t)
    scored = mr.FMRegressor(factorSize=2, maxIter=10, seed=1).fit(df).transform(df)
    return scored.agg(F.count("*").alias("n"), F.bool_and(~F.isnan("prediction")).alias("finite"))


# -- clusters ----------------------------------------------------------------------------

def _add_clusters(name: str, estimator) -> None:
    @case(name, "SELECT count(*) AS n, TRUE AS within_k FROM embeddings")
    def build(t: Tables) -> DataFrame:
        df = points(t)
        scored = estimator().fit(df).transform(df)
        return scored.agg(F.count("*").alias("n"), (F.min("prediction").between(0, 4) & F.max("prediction").between(0, 4)).alias("within_k"))


_add_clusters("q_cluster_kmeans", lambda: ml_clusters.KMeans(k=5, seed=1, maxIter=10))
_add_clusters("q_cluster_bisecting", lambda: ml_clusters.BisectingKMeans(k=5, seed=1, maxIter=5))


@case("q_cluster_gaussian_mixture", "SELECT count(*) AS n, TRUE AS sums_to_one FROM lineitem")
def cluster_gaussian_mixture(t: Tables) -> DataFrame:
    df = flat_lines(t)
    scored = ml_clusters.GaussianMixture(k=2, seed=1, maxIter=5).fit(df).transform(df)
    p = vector_to_array("probability")
    return scored.agg(F.count("*").alias("n"), F.bool_and(F.abs(p[0] + p[1] - 1) < 1e-6).alias("sums_to_one"))


@case("q_cluster_topics", "SELECT count(*) AS n, TRUE AS sums_to_one FROM documents")
def cluster_topics(t: Tables) -> DataFrame:
    df = mf.RegexTokenizer(inputCol="text", outputCol="w", pattern=r"\s+").transform(t.documents.select("doc_id", "text"))
    df = mf.HashingTF(inputCol="w", outputCol="features", numFeatures=256).transform(df)
    scored = ml_clusters.LDA(k=3, maxIter=3, seed=1).fit(df).transform(df)
    total = F.aggregate(vector_to_array("topicDistribution"), F.lit(0.0), lambda acc, v: acc + v)
    return scored.agg(F.count("*").alias("n"), F.bool_and((F.abs(total - 1) < 1e-6) | (total == 0)).alias("sums_to_one"))


@case("q_cluster_power_iteration", """
SELECT count(DISTINCT v) AS n, TRUE AS two_sides FROM (SELECT o_custkey % 40 AS v FROM orders UNION SELECT 100 + l_suppkey % 40 FROM lineitem)""")
def cluster_power_iteration(t: Tables) -> DataFrame:
    """Customers' and suppliers' groups as one weighted graph, cut in two."""
    pairs = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    edges = pairs.groupBy((F.col("o_custkey") % 40).alias("src"), (F.col("l_suppkey") % 40 + 100).alias("dst")).agg(F.count("*").cast("double").alias("weight"))
    found = ml_clusters.PowerIterationClustering(k=2, maxIter=10, weightCol="weight").assignClusters(edges)
    return found.agg(F.count("*").alias("n"), (F.max("cluster") <= 1).alias("two_sides"))


# -- patterns and recommendation -------------------------------------------------------------

#: Every set of kinds of every order; a set's kinds are in order of name.
_SETS = """
WITH RECURSIVE kinds AS (SELECT DISTINCT l_orderkey AS o, p_type AS k FROM lineitem JOIN part ON l_partkey = p_partkey),
sets AS (SELECT o, [k] AS s FROM kinds UNION ALL SELECT sets.o, list_append(s, k) FROM sets JOIN kinds ON sets.o = kinds.o AND k > s[len(s)]),
often AS (SELECT s, count(*) AS freq FROM sets GROUP BY s HAVING count(*) >= {} * (SELECT count(DISTINCT o) FROM kinds))"""


def _baskets(t: Tables) -> DataFrame:
    """Kinds of part bought together; a basket is one order."""
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return lines.groupBy("l_orderkey").agg(F.collect_set("p_type").alias("items"))


@case("q_pattern_itemsets", _SETS.format(0.1) + " SELECT array_to_string(s, ',') AS items, freq FROM often")
def pattern_itemsets(t: Tables) -> DataFrame:
    found = fpm.FPGrowth(minSupport=0.1, minConfidence=0.5).fit(_baskets(t)).freqItemsets
    return found.select(F.array_join(F.array_sort("items"), ",").alias("items"), "freq")


@case("q_pattern_rules", _SETS.format(0.1) + """,
ends AS (SELECT s, freq, unnest(s) AS e FROM often WHERE len(s) > 1),
rules AS (SELECT list_filter(s, lambda x: x <> e) AS a, e, freq FROM ends)
SELECT array_to_string(a, ',') AS antecedent, e AS consequent, round(rules.freq * 1.0 / often.freq, 6) AS confidence
FROM rules JOIN often ON a = often.s WHERE rules.freq * 1.0 / often.freq >= 0.4""")
def pattern_rules(t: Tables) -> DataFrame:
    rules = fpm.FPGrowth(minSupport=0.1, minConfidence=0.4).fit(_baskets(t)).associationRules
    return rules.select(
        F.array_join(F.array_sort("antecedent"), ",").alias("antecedent"), F.col("consequent")[0].alias("consequent"),
        F.round("confidence", 6).alias("confidence"),
    )


@case("q_pattern_sequences", """
WITH RECURSIVE t AS (SELECT conv_id AS c, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) AS n FROM conversations),
steps AS (SELECT c, role AS steps, n FROM t UNION SELECT x.c, x.steps || '>' || y.role, y.n FROM steps x JOIN t y ON x.c = y.c AND x.n < y.n)
SELECT steps, count(DISTINCT c) AS freq FROM steps GROUP BY 1 HAVING count(DISTINCT c) >= 0.1 * (SELECT count(DISTINCT c) FROM t)""")
def pattern_sequences(t: Tables) -> DataFrame:
    """All frequent orders of roles in talks; a sequence is one talk, which has few turns."""
    turns = t.conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("x"))
    sequences = turns.select(F.transform("x", lambda e: F.array(e["role"])).alias("sequence"))
    longest = sequences.agg(F.coalesce(F.max(F.size("sequence")), F.lit(1))).first()[0]
    found = fpm.PrefixSpan(minSupport=0.1, maxPatternLength=max(longest, 1)).findFrequentSequentialPatterns(sequences)
    return found.select(F.array_join(F.transform("sequence", lambda s: s[0]), ">").alias("steps"), "freq")


@case("q_model_als", "SELECT count(*) AS n, TRUE AS better, TRUE AS three_each FROM (SELECT DISTINCT o_custkey, p_type FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey)")
def model_als(t: Tables) -> DataFrame:
    """Quantities by customer and kind of part as ratings; three kinds recommended to each customer."""
    kind = F.pmod(F.xxhash64("p_type"), F.lit(1000003)).cast("int")
    lines = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    ratings = lines.groupBy(F.col("o_custkey").cast("int").alias("user"), kind.alias("item")).agg(F.avg("l_quantity").alias("rating"))
    fit = recommendation.ALS(rank=4, maxIter=5, userCol="user", itemCol="item", ratingCol="rating", seed=1).fit(ratings)
    offers = fit.recommendForAllUsers(3).agg((F.min(F.size("recommendations")) == 3).alias("three_each"))
    return _better_number(fit.transform(ratings), "rating").crossJoin(offers)  # one row beside one row


# -- tests and statistics ---------------------------------------------------------------------

@case("q_stats_vector_summary", """
SELECT round(avg(l_quantity), 6) AS mean, round(var_samp(l_quantity), 6) AS var, count(*) AS n, min(l_quantity) AS lo, max(l_quantity) AS hi, round(sum(l_quantity), 2) AS total FROM lineitem""")
def stats_vector_summary(t: Tables) -> DataFrame:
    s = stat.Summarizer.metrics("mean", "variance", "count", "min", "max", "sum").summary(F.col("features")).alias("s")
    out = flat_lines(t).select(s)

    def first(field: str) -> Column:
        return vector_to_array(f"s.{field}")[0]

    return out.select(
        F.round(first("mean"), 6).alias("mean"), F.round(first("variance"), 6).alias("var"), F.col("s.count").alias("n"), first("min").alias("lo"),
        first("max").alias("hi"), F.round(first("sum"), 2).alias("total"),
    )


@case("q_stats_correlation", "SELECT round(corr(l_quantity, l_discount), 6) AS r FROM lineitem")
def stats_correlation(t: Tables) -> DataFrame:
    found = stat.Correlation.corr(flat_lines(t), "features", "pearson").first()[0]  # two by two
    return _one_row(t, {"r": found.toArray()[0, 1]})


@case("q_stats_rank_correlation", """
SELECT round(corr(a, b), 6) AS rho FROM (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a,
rank() OVER (ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_discount) - 1) / 2.0 AS b FROM lineitem)""")
def stats_rank_correlation(t: Tables) -> DataFrame:
    return rank_correlation(t.lineitem, "l_quantity", "l_discount").select(F.round("rho", 6).alias("rho"))


@case("q_stats_chi_square", """
WITH o AS (SELECT l_linestatus AS a, l_returnflag AS b, count(*) AS c FROM lineitem GROUP BY 1, 2), n AS (SELECT sum(c) AS n FROM o),
a AS (SELECT a, sum(c) AS ca FROM o GROUP BY 1), b AS (SELECT b, sum(c) AS cb FROM o GROUP BY 1)
SELECT round(sum((coalesce(c, 0) - ca * cb / n) ** 2 / (ca * cb / n)), 4) AS statistic FROM a CROSS JOIN b CROSS JOIN n LEFT JOIN o USING (a, b)""")
def stats_chi_square(t: Tables) -> DataFrame:
    label = (F.col("l_linestatus") == "F").cast("double")
    flag = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0)
    df = mf.VectorAssembler(inputCols=["flag"], outputCol="features").transform(t.lineitem.select(label.alias("label"), flag.alias("flag")))
    return stat.ChiSquareTest.test(df, "features", "label", flatten=True).select(F.round("statistic", 4).alias("statistic"))


@case("q_stats_kolmogorov_smirnov", "SELECT TRUE AS uniform_far, TRUE AS in_range FROM lineitem LIMIT 1")
def stats_kolmogorov_smirnov(t: Tables) -> DataFrame:
    """Quantities are spread evenly, so a normal shape is refused."""
    df = t.lineitem.select(F.col("l_quantity").alias("x"))
    out = stat.KolmogorovSmirnovTest.test(df, "x", "norm", 25.5, 14.4)
    return out.select((F.col("pValue") < 0.01).alias("uniform_far"), F.col("statistic").between(0, 1).alias("in_range"))


@case("q_stats_kernel_density", """
SELECT p AS point, round(avg(exp(-0.5 * pow((o_totalprice - p) / 20000.0, 2))) / (20000.0 * sqrt(2 * pi())), 12) AS density
FROM orders, (SELECT unnest([50000.0, 250000.0, 450000.0]::DOUBLE[]) AS p) GROUP BY 1""")
def stats_kernel_density(t: Tables) -> DataFrame:
    out = matrix.kernel_density(t.orders, "o_totalprice", [50000.0, 250000.0, 450000.0], 20000.0)
    return out.select("point", F.round("density", 12).alias("density"))


@case("q_stats_random_columns", "SELECT count(*) AS n, TRUE AS uniform_, TRUE AS normal_, TRUE AS exponential_, TRUE AS log_normal FROM lineitem")
def stats_random_columns(t: Tables) -> DataFrame:
    """Random numbers of four shapes beside every row, each with the mean it should have."""
    df = t.lineitem.select(
        F.rand(1).alias("u"), F.randn(2).alias("z"), (-F.log(1 - F.rand(3))).alias("e"), F.exp(0.25 * F.randn(4)).alias("g")
    )
    width = 6 / F.sqrt(F.count("*"))
    means = {"uniform_": ("u", 0.5), "normal_": ("z", 0.0), "exponential_": ("e", 1.0), "log_normal": ("g", 2.718281828459045 ** 0.03125)}
    return df.agg(F.count("*").alias("n"), *[(F.abs(F.avg(c) - m) < width).alias(n) for n, (c, m) in means.items()])


# -- evaluation ----------------------------------------------------------------------------

_SCORED = "(SELECT CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END AS label, l_quantity AS score, CASE WHEN l_quantity > 25 THEN 1.0 ELSE 0.0 END AS prediction FROM lineitem)"


def scored(t: Tables) -> DataFrame:
    return t.lineitem.select(
        (F.col("l_linestatus") == "F").cast("double").alias("label"), F.col("l_quantity").alias("rawPrediction"),
        (F.col("l_quantity") > 25).cast("double").alias("prediction"),
    )


def _one_row(t: Tables, values: dict[str, float], scale: int = 6) -> DataFrame:
    frame = t.spark.createDataFrame([tuple(map(float, values.values()))], ", ".join(f"{n} double" for n in values))
    return frame.select(*[F.round(n, scale).alias(n) for n in values])


@case("q_evaluate_binary", f"""
WITH s AS {_SCORED}, g AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM s GROUP BY 1),
c AS (SELECT p, n, sum(p) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) - p AS below, sum(n) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) - n AS nbelow FROM g)
SELECT round(sum(p * (nbelow + n / 2.0)) / (sum(p) * sum(n)), 5) AS auc FROM c""")
def evaluate_binary(t: Tables) -> DataFrame:
    return _one_row(t, {"auc": me.BinaryClassificationEvaluator().evaluate(scored(t))}, 5)


@case("q_evaluate_multiclass", f"""
WITH s AS {_SCORED}, c AS (SELECT label, count(*) AS n, count(*) FILTER (prediction = label) AS hit FROM s GROUP BY 1), p AS (SELECT prediction AS label, count(*) AS m FROM s GROUP BY 1)
SELECT round(sum(hit) / sum(n), 6) AS accuracy, round(sum(n * (2.0 * hit / (n + m))) / sum(n), 6) AS f1, round(sum(n * (hit * 1.0 / m)) / sum(n), 6) AS weighted_precision FROM c JOIN p USING (label)""")
def evaluate_multiclass(t: Tables) -> DataFrame:
    df = scored(t).cache()
    names = {"accuracy": "accuracy", "f1": "f1", "weighted_precision": "weightedPrecision"}
    out = _one_row(t, {k: me.MulticlassClassificationEvaluator(metricName=v).evaluate(df) for k, v in names.items()})
    df.unpersist()
    return out


@case("q_evaluate_regression", """
SELECT round(sqrt(avg(pow(l_extendedprice - l_quantity * 1500, 2))), 3) AS rmse, round(avg(abs(l_extendedprice - l_quantity * 1500)), 3) AS mae,
       round(1 - sum(pow(l_extendedprice - l_quantity * 1500, 2)) / (var_pop(l_extendedprice) * count(*)), 6) AS r2 FROM lineitem""")
def evaluate_regression(t: Tables) -> DataFrame:
    df = t.lineitem.select(F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500).alias("prediction"))
    value = {m: me.RegressionEvaluator(metricName=m).evaluate(df) for m in ("rmse", "mae", "r2")}
    frame = _one_row(t, value, 6)
    return frame.select(F.round("rmse", 3).alias("rmse"), F.round("mae", 3).alias("mae"), "r2")


@case("q_evaluate_ranking", """
SELECT round(avg(CASE WHEN c_nationkey % 3 = 0 THEN 1.0 WHEN c_nationkey % 3 = 1 THEN 0.5 ELSE 1.0 / 3 END), 6) AS map FROM customer""")
def evaluate_ranking(t: Tables) -> DataFrame:
    """Three ranked labels and one right one: its place gives the mean precision."""
    right = (F.col("c_nationkey") % 3).cast("double")
    df = t.customer.select(F.array(F.lit(0.0), F.lit(1.0), F.lit(2.0)).alias("prediction"), F.array(right).alias("label"))
    return _one_row(t, {"map": me.RankingEvaluator(metricName="meanAveragePrecision").evaluate(df)})


@case("q_evaluate_multilabel", """
SELECT round(avg(CASE WHEN c_nationkey % 3 < 2 THEN 0.5 ELSE 0.0 END), 6) AS precision_ FROM customer""")
def evaluate_multilabel(t: Tables) -> DataFrame:
    right = (F.col("c_nationkey") % 3).cast("double")
    df = t.customer.select(F.array(F.lit(0.0), F.lit(1.0)).alias("prediction"), F.array(right).alias("label"))
    return _one_row(t, {"precision_": me.MultilabelClassificationEvaluator(metricName="precision").evaluate(df)})


@case("q_evaluate_clusters", "SELECT TRUE AS in_range FROM embeddings LIMIT 1")
def evaluate_clusters(t: Tables) -> DataFrame:
    df = points(t)
    found = ml_clusters.KMeans(k=5, seed=1, maxIter=5).fit(df).transform(df)
    silhouette = me.ClusteringEvaluator().evaluate(found)
    return t.spark.createDataFrame([(-1 <= silhouette <= 1,)], "in_range boolean")


@case("q_tune_cross_validation", "SELECT count(*) AS n, TRUE AS better FROM embeddings")
def tune_cross_validation(t: Tables) -> DataFrame:
    """A small grid over a chain of steps, chosen by folds; the best chain scores all rows."""
    df = points(t)
    logit = mc.LogisticRegression(maxIter=8, featuresCol="scaled")
    chain = Pipeline(stages=[mf.StandardScaler(inputCol="features", outputCol="scaled"), logit])
    grid = tuning.ParamGridBuilder().addGrid(logit.regParam, [0.01, 0.1]).build()
    search = tuning.CrossValidator(estimator=chain, estimatorParamMaps=grid, evaluator=me.BinaryClassificationEvaluator(), numFolds=2, seed=1, parallelism=2)
    return _better_class(search.fit(df).transform(df))


@case("q_tune_single_split", "SELECT count(*) AS n, TRUE AS better FROM lineitem")
def tune_single_split(t: Tables) -> DataFrame:
    df = flat_lines(t)
    model = mr.LinearRegression(maxIter=5)
    grid = tuning.ParamGridBuilder().addGrid(model.regParam, [0.0, 10.0]).build()
    search = tuning.TrainValidationSplit(estimator=model, estimatorParamMaps=grid, evaluator=me.RegressionEvaluator(), trainRatio=0.7, seed=1)
    return _better_number(search.fit(df).transform(df))


@case("q_model_saved_chain", "SELECT count(*) AS n, TRUE AS better FROM lineitem")
def model_saved_chain(t: Tables) -> DataFrame:
    """A fitted chain written to the shared folder and read back."""
    raw = t.lineitem.select("l_quantity", "l_discount", F.col("l_extendedprice").alias("label"))
    chain = Pipeline(stages=[mf.VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features"), mr.LinearRegression()])
    path = scratch(t.spark, "model")
    chain.fit(raw).write().overwrite().save(path)
    return _better_number(PipelineModel.load(path).transform(raw))


# -- matrices ------------------------------------------------------------------------------

_ENTRIES = "(SELECT o_custkey AS i, CAST(left(o_orderpriority, 1) AS BIGINT) AS j, count(*)::DOUBLE AS v FROM orders GROUP BY 1, 2)"


def entries(t: Tables) -> DataFrame:
    """Orders per customer and priority level as a matrix."""
    return t.orders.groupBy(F.col("o_custkey").alias("i"), F.substring("o_orderpriority", 1, 1).cast("bigint").alias("j")).agg(
        F.count("*").cast("double").alias("v")
    )


@case("q_matrix_multiply", f"""
WITH a AS {_ENTRIES}, b AS (SELECT CAST(left(o_orderpriority, 1) AS BIGINT) AS i, ascii(o_orderstatus)::BIGINT AS j, count(*)::DOUBLE AS v FROM orders GROUP BY 1, 2)
SELECT a.i, b.j, sum(a.v * b.v) AS v FROM a JOIN b ON a.j = b.i GROUP BY 1, 2""")
def matrix_multiply(t: Tables) -> DataFrame:
    b = t.orders.groupBy(F.substring("o_orderpriority", 1, 1).cast("bigint").alias("i"), F.ascii("o_orderstatus").cast("bigint").alias("j")).agg(
        F.count("*").cast("double").alias("v")
    )
    return matrix.multiply(entries(t), b)


@case("q_matrix_sum_transpose", f"WITH a AS {_ENTRIES} SELECT j AS i, i AS j, v * 3 AS v FROM a")
def matrix_sum_transpose(t: Tables) -> DataFrame:
    a = matrix.transpose(entries(t))
    return matrix.add(a, matrix.scale(a, 2.0))


@case("q_matrix_gram", """
WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS d FROM embeddings)
SELECT a.d AS i, b.d AS j, round(sum(a.v * b.v), 5) AS v FROM x a JOIN x b USING (vec_id) GROUP BY 1, 2""")
def matrix_gram(t: Tables) -> DataFrame:
    return matrix.gram_of_rows(t.embeddings, "embedding").select("i", "j", F.round("v", 5).alias("v"))


@case("q_matrix_column_similarity", """
WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS d FROM embeddings),
n AS (SELECT d, sqrt(sum(v * v)) AS norm FROM x GROUP BY 1)
SELECT a.d AS i, b.d AS j, round(sum(a.v * b.v) / any_value(p.norm * q.norm), 5) AS v FROM x a JOIN x b ON a.vec_id = b.vec_id AND a.d < b.d
JOIN n p ON p.d = a.d JOIN n q ON q.d = b.d GROUP BY 1, 2""")
def matrix_column_similarity(t: Tables) -> DataFrame:
    gram = matrix.gram_of_rows(t.embeddings, "embedding")
    return matrix.column_similarities(gram).select("i", "j", F.round("v", 5).alias("v"))


# -- models over streams -----------------------------------------------------------------------

@case("q_stream_centroids", "SELECT count(*) AS n, TRUE AS closer FROM embeddings")
def stream_centroids(t: Tables) -> DataFrame:
    """Centres pulled by each batch of a stream; rows end nearer to them than to the start."""
    x = F.col("embedding").cast("array<double>").alias("x")
    first = [r.x for r in t.embeddings.select(x).orderBy("vec_id").limit(5).collect()]  # the k start centres
    model, start = CentroidModel(first, decay=0.9), CentroidModel(first)
    stream = table_stream(t.spark, t.folder, "embeddings").select(x)
    base = scratch(t.spark, "centroids")
    finish(stream.writeStream.foreachBatch(lambda rows, _: model.update(rows, "x")).option("checkpointLocation", base).trigger(availableNow=True).start())
    rows = t.embeddings.select(x)

    def cost(m: CentroidModel) -> Column:
        from millrace.streaming.learning import squared_distance

        return F.array_min(F.array(*[squared_distance(F.col("x"), c) for c in m.centres]))

    return rows.agg(F.count("*").alias("n"), (F.sum(cost(model)) < F.sum(cost(start))).alias("closer"))


@case("q_stream_gradient_regression", "SELECT count(*) AS n, TRUE AS better FROM lineitem")
def stream_gradient_regression(t: Tables) -> DataFrame:
    """One gradient step per batch; several passes stand for a longer stream."""
    model = GradientModel(1, step=0.5)

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(((F.col("l_quantity") - 25.5) / 14.4).alias("q"), (F.col("l_quantity") / 50 + F.col("l_discount")).alias("label"))

    for _ in range(6):
        stream = shaped(table_stream(t.spark, t.folder, "lineitem"))
        base = scratch(t.spark, "gradient")
        finish(stream.writeStream.foreachBatch(lambda rows, _: model.update(rows, ["q"], "label")).option("checkpointLocation", base).trigger(availableNow=True).start())
    return _better_number(shaped(t.lineitem).withColumn("prediction", model.score(["q"])))


def _mornings_then_rest(t: Tables, make, update) -> DataFrame:
    """The log's last state of a model that learns the mornings' events, is stopped, and learns the others as a new object."""
    base = scratch(t.spark, "model")
    rows = t.events.select((F.col("value") / 100).alias("x"), F.array(F.col("value") / 100).alias("xs"),
                           (F.col("event_type") == "purchase").cast("double").alias("y"), (F.hour("ts") < 12).alias("morning"))
    log = ModelLog(t.spark, f"{base}/log")
    for morning in (True, False):
        rows.where(F.col("morning") == morning).write.mode("append").parquet(f"{base}/in")
        model = make()
        finish(train(file_stream(t.spark, f"{base}/in", rows.schema), model, lambda batch, m=model: update(m, batch), log, f"{base}/state"))
    return log.rows()


_HALVES = """
WITH e AS (SELECT value / 100 AS x, CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y, hour(ts) < 12 AS morning FROM events),"""


@case("q_stream_logistic_restart", _HALVES + """
a AS (SELECT -2 * avg(0.5 - y) AS w0, -2 * avg((0.5 - y) * x) AS w1 FROM e WHERE morning),
b AS (SELECT max(w0) AS w0, max(w1) AS w1, avg(p - y) AS g0, avg((p - y) * x) AS g1 FROM (SELECT *, 1 / (1 + exp(-(w0 + w1 * x))) AS p FROM e, a WHERE NOT morning))
SELECT 0 AS place, round(w0 - 2 / sqrt(2) * g0, 6) AS weight, 2 AS batches FROM b UNION ALL SELECT 1, round(w1 - 2 / sqrt(2) * g1, 6), 2 FROM b""")
def stream_logistic_restart(t: Tables) -> DataFrame:
    """Logistic regression by a gradient step per batch, over a restart."""
    state = _mornings_then_rest(t, lambda: GradientModel(1, step=2.0, logistic=True), lambda m, rows: m.update(rows, ["x"], "y"))
    found = state.select(F.from_json("state", "weights ARRAY<DOUBLE>, batches INT").alias("s"))
    return found.select(F.posexplode("s.weights").alias("place", "weight"), F.col("s.batches").alias("batches")).withColumn("weight", F.round("weight", 6))


@case("q_stream_centroids_restart", _HALVES + """
a AS (SELECT CASE WHEN (x - 0.2) ** 2 <= (x - 0.8) ** 2 THEN 0 ELSE 1 END AS c, sum(x) AS s, count(*) AS n FROM e WHERE morning GROUP BY 1),
m AS (SELECT max(CASE c WHEN 0 THEN s / n END) AS c0, max(CASE c WHEN 1 THEN s / n END) AS c1 FROM a),
b AS (SELECT CASE WHEN (x - c0) ** 2 <= (x - c1) ** 2 THEN 0 ELSE 1 END AS c, sum(x) AS s, count(*) AS n FROM e, m WHERE NOT morning GROUP BY 1)
SELECT a.c AS centre, round((a.s / 2 + b.s) / (a.n / 2 + b.n), 6) AS at, round(a.n / 2 + b.n, 1) AS weight FROM a JOIN b ON a.c = b.c""")
def stream_centroids_restart(t: Tables) -> DataFrame:
    """K-means with half of the old weight kept at each batch, over a restart."""
    state = _mornings_then_rest(t, lambda: CentroidModel([[0.2], [0.8]], decay=0.5), lambda m, rows: m.update(rows, "xs"))
    found = state.select(F.from_json("state", "centres ARRAY<ARRAY<DOUBLE>>, weights ARRAY<DOUBLE>").alias("s"))
    pairs = found.select(F.posexplode(F.arrays_zip("s.centres", "s.weights")).alias("centre", "p"))
    return pairs.select("centre", F.round(F.col("p.centres")[0], 6).alias("at"), F.round("p.weights", 1).alias("weight"))
