"""Model, explanation and method-comparison queries."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ledgerlight.ml import explain as ex
from ledgerlight.ml import iforest, lof, prep
from ledgerlight.ml import supervised as sup
from ledgerlight.operators import evaluate as ev
from ledgerlight.operators import marts
from ledgerlight.operators.cells import quantile
from ledgerlight.plans import profiles
from ledgerlight.plans.checks import SCORE, STORE_NUMBERS, STORE_SQL, amount_score, store
from ledgerlight.plans.features import RISK_SQL
from ledgerlight.plans.registry import TXN, query
from ledgerlight.session import configure, cut, scratch_dir
from ledgerlight.sources import canonical as src
from ledgerlight.sources import files

ID = "transaction_id"
NOT_FEATURES = ["is_fraud"]


def matrix(spark, d):
    t = store(spark, d)
    return prep.basic_matrix(t, profiles.numeric_columns(t, NOT_FEATURES))


def scaled_matrix(spark, d):
    m, features = matrix(spark, d)
    return prep.scale(m, prep.fit_scaler(m, features)), features


def _details(df, spark, d):
    """Merchant columns for scored rows."""
    names = src.transactions(spark, d).select(ID, "merchant_name", "merchant_category")
    return df.join(names, ID)


# --- preparation ---------------------------------------------------------------------------------------------


@query("impute_median", f"""WITH {TXN}, p AS (SELECT transaction_id, CASE WHEN amount > 0 THEN amount END AS debit,
  CASE WHEN abs(amount) < 50 THEN amount END AS small FROM txn)
SELECT transaction_id, coalesce(debit, (SELECT quantile_cont(debit, 0.5) FROM p)) AS debit, coalesce(small, (SELECT quantile_cont(small, 0.5) FROM p)) AS small FROM p""", "debit small")
def impute_median(spark, d):
    t = src.transactions(spark, d)
    # Rows without a value: null in one column, infinite in the other.
    p = t.select(
        ID,
        F.when(F.col("amount") > 0, F.col("amount")).alias("debit"),
        F.when(F.abs("amount") < 50, F.col("amount")).otherwise(float("inf")).alias("small"),
    )
    return prep.impute_median(p, ["debit", "small"])


@query("variance_filter", f"""{STORE_SQL}
SELECT feature, variance, CASE WHEN variance > 0.05 THEN 1 ELSE 0 END AS kept FROM (
{' UNION ALL '.join(f"SELECT '{c}' AS feature, var_pop({c}) AS variance FROM store" for c in STORE_NUMBERS)}) v""", "variance")
def variance_filter(spark, d):
    t = store(spark, d)
    return prep.variances(t, profiles.numeric_columns(t, []))


@query("standardize", f"""WITH {TXN}, p AS (SELECT transaction_id, amount, is_fraud, 1.0 AS constant FROM txn)
SELECT transaction_id, (amount - (SELECT avg(amount) FROM p)) / (SELECT stddev_pop(amount) FROM p) AS amount,
  (is_fraud - (SELECT avg(is_fraud) FROM p)) / (SELECT stddev_pop(is_fraud) FROM p) AS is_fraud, 0.0 AS constant FROM p""", "amount is_fraud constant")
def standardize(spark, d):
    t = src.transactions(spark, d).select(ID, "amount", F.col("is_fraud").cast("double").alias("is_fraud"), F.lit(1.0).alias("constant"))
    columns = ["amount", "is_fraud", "constant"]
    return prep.scale(t, prep.fit_scaler(t, columns))


@query("stratified_split", f"""WITH {TXN} SELECT transaction_id, is_fraud, CASE WHEN percent_rank() OVER (PARTITION BY is_fraud
  ORDER BY md5(concat(transaction_id, '42'))) <= 0.8 THEN 1 ELSE 0 END AS is_train FROM txn""")
def stratified_split(spark, d):
    t = src.transactions(spark, d).select(ID, "is_fraud")
    return prep.stratified_split(t, ID, "is_fraud")


@query("enhanced_matrix")
def enhanced_matrix(spark, d):
    t = store(spark, d)
    m, kept = prep.enhanced_matrix(t, profiles.numeric_columns(t, NOT_FEATURES))
    return m.select(ID, *kept)


# --- models --------------------------------------------------------------------------------------------------


def forest_scores(spark, d):
    m, features = scaled_matrix(spark, d)
    return iforest.detect_variant(m, ID, features, "basic")


@query("iforest_scores")
def iforest_scores(spark, d):
    return forest_scores(spark, d).select(ID, "anomaly_score", "is_anomaly")


@query("iforest_variants", f"""WITH {TXN} SELECT variant, count(*) AS n_rows, CAST(floor(count(*) * share + 1e-6) AS BIGINT) AS n_flagged, 1 AS scores_in_range
FROM txn CROSS JOIN (VALUES ('enhanced', 0.05), ('evaluator', 0.03)) v(variant, share) GROUP BY variant, share""")
def iforest_variants(spark, d):
    """Rows, flagged rows and range of the scores of the two larger settings."""
    m, features = scaled_matrix(spark, d)
    parts = []
    for variant in ("enhanced", "evaluator"):
        found = iforest.detect_variant(m, ID, features, variant)
        inside = F.min(F.col("anomaly_score").between(0.0, 1.0).cast("int"))
        parts.append(
            found.agg(F.count("*").alias("n_rows"), F.sum("is_anomaly").cast("long").alias("n_flagged"), inside.alias("scores_in_range")).select(
                F.lit(variant).alias("variant"), "n_rows", "n_flagged", "scores_in_range"
            )
        )
    return parts[0].unionByName(parts[1])


@query("lof_scores", """WITH p AS (SELECT a.vec_id AS i, b.vec_id AS j, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS dist
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY dist, j) AS r FROM p) n WHERE r <= 20),
reach AS (SELECT i, max(dist) AS kd FROM near GROUP BY 1),
dens AS (SELECT n.i, 1 / (avg(greatest(n.dist, r.kd)) + 1e-10) AS lrd FROM near n JOIN reach r ON r.i = n.j GROUP BY 1)
SELECT n.i AS vec_id, avg(b.lrd) / any_value(a.lrd) AS lof FROM near n JOIN dens a ON a.i = n.i JOIN dens b ON b.i = n.j GROUP BY 1""", "lof")
def lof_scores(spark, d):
    configure(spark)
    e = src.table(spark, d, "embeddings")
    return lof.outlier_factors(e, "vec_id", F.col("embedding"))


@query("lof_transactions")
def lof_transactions(spark, d):
    """Outlier factor of every transaction, the most outlying 5 % flagged."""
    m, features = scaled_matrix(spark, d)
    keyed = m.withColumn("row_hash", F.xxhash64(ID))
    x = F.array(*[F.col(c) for c in features])
    scored = keyed.select(ID, "row_hash").join(lof.outlier_factors(keyed, "row_hash", x), "row_hash")
    return prep.flag_top(cut(scored), "lof", 0.05, "is_anomaly").select(ID, "lof", "is_anomaly")


@query("reconstruction_scores")
def reconstruction_scores(spark, d):
    m, features = scaled_matrix(spark, d)
    scored = sup.score_reconstruction(m, sup.fit_reconstruction(m, features), features)
    return prep.flag_top(cut(scored), "reconstruction_error", 0.05, "is_anomaly").select(ID, "reconstruction_error", "is_anomaly")


@query("rf_scores")
def rf_scores(spark, d):
    m, features = matrix(spark, d)
    model = sup.fit_random_forest(m, features)
    return sup.score_random_forest(m, model).select(ID, "is_fraud", "rf_score")


@query("ensemble_scores", f"""WITH {TXN}, s AS (SELECT transaction_id, {SCORE} AS iso, hour(timestamp) / 24 AS rf FROM txn),
e AS (SELECT transaction_id, 0.3 * (iso - (SELECT min(iso) FROM s)) / ((SELECT max(iso) - min(iso) FROM s) + 1e-8) + 0.7 * rf AS ensemble_score FROM s)
SELECT *, CASE WHEN ensemble_score > (SELECT quantile_cont(ensemble_score, 0.97) FROM e) THEN 1 ELSE 0 END AS ensemble_flag FROM e""", "ensemble_score")
def ensemble_scores(spark, d):
    """The ensemble's arithmetic on two given score columns."""
    t = src.transactions(spark, d).select(ID, amount_score().alias("iso_score"), (F.hour("timestamp") / 24).alias("rf_score"))
    return sup.ensemble(t).select(ID, "ensemble_score", "ensemble_flag")


def ensemble_table(spark, d):
    """All three methods on the feature store, fitted and scored on all rows, written once."""
    m, features = matrix(spark, d)
    return ensemble_scored(m, m, features)


EARLIER = 0.8  # share of the time line's rows that models are fitted on before they are compared on the later ones


def time_split(rows):
    """The rows with `is_later`: 1 behind the instant that EARLIER of the rows lie up to."""
    at = quantile(rows.select(F.unix_micros("timestamp").alias("us")), "us", EARLIER)
    return rows.withColumn("is_later", (F.unix_micros("timestamp") > at.scalar()).cast("int"))


def later_scores(spark, d):
    """The three methods fitted, scaled and thresholded on the earlier rows: scores of the later ones, and all rows' split."""
    m, features = matrix(spark, d)
    rows = cut(time_split(m), "split")
    return ensemble_scored(rows.where("is_later = 0"), rows.where("is_later = 1"), features), rows


def ensemble_scored(known, rows, features):
    """`rows` with the scores and flags of models, scalers and thresholds that come from `known` alone."""
    scaler = prep.fit_scaler(known, features)
    forest = iforest.fit(prep.scale(known, scaler), ID, features)
    trees = sup.fit_random_forest(known, features)

    def both(part):
        iso = forest.score(prep.scale(part, scaler), "iso_score").select(ID, "iso_score")
        return cut(sup.score_random_forest(part, trees).join(iso, ID), "scores")

    scored = both(rows)
    seen = scored if known is rows else both(known)
    scored = sup.ensemble(scored, known=seen)
    scored = prep.flag_top(scored, "iso_score", 0.05, "iso_flag", known=seen)
    return scored.withColumn("rf_flag", (F.col("rf_score") > 0.5).cast("int"))


def comparison(scored):
    parts = [
        ev.evaluate(scored, "isolation_forest", "is_fraud", "iso_flag", "iso_score"),
        ev.evaluate(scored, "random_forest", "is_fraud", "rf_flag", "rf_score"),
        ev.evaluate(scored, "ensemble", "is_fraud", "ensemble_flag", "ensemble_score"),
    ]
    return src.union_splits(*parts)


def _ranges(rows):
    """First and last instant of the rows that models were fitted on and of those that they are compared on."""

    def end(side, least):
        text = F.date_format(least(F.when(F.col("is_later") == side, F.col("timestamp"))), "yyyy-MM-dd HH:mm:ss")
        return text.alias(f"{('train', 'test')[side]}_{'from' if least is F.min else 'to'}")

    return rows.agg(*[end(side, least) for side in (0, 1) for least in (F.min, F.max)])


SPLIT_SQL = f"""WITH {TXN}, split AS (SELECT *, CASE WHEN epoch_us(timestamp) > (SELECT quantile_cont(epoch_us(timestamp)::DOUBLE, {EARLIER}) FROM txn) THEN 1 ELSE 0 END AS is_later FROM txn)"""


@query("eval_split", f"""{SPLIT_SQL} SELECT is_later, count(*) AS n_rows, CAST(sum(is_fraud) AS BIGINT) AS n_fraud, strftime(min(timestamp), '%Y-%m-%d %H:%M:%S') AS first_seen,
  strftime(max(timestamp), '%Y-%m-%d %H:%M:%S') AS last_seen FROM split GROUP BY 1""")
def eval_split(spark, d):
    """Rows, frauds and time range of the two sides of the comparison."""
    ends = [F.date_format(f("timestamp"), "yyyy-MM-dd HH:mm:ss").alias(n) for f, n in ((F.min, "first_seen"), (F.max, "last_seen"))]
    rows = time_split(src.transactions(spark, d))
    return rows.groupBy("is_later").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("is_fraud").cast("long").alias("n_fraud"), *ends)


@query("best_method")
def best_method(spark, d):
    """The method with the best F1 on rows later than those it was fitted on."""
    scored, rows = later_scores(spark, d)
    return ev.best_method(comparison(cut(scored))).crossJoin(_ranges(rows))


@query("eval_log")
def eval_log(spark, d):
    scored, rows = later_scores(spark, d)
    results = comparison(cut(scored)).crossJoin(_ranges(rows))
    path = files.append_evaluation(results, scratch_dir(spark, "evaluation"))
    return spark.read.parquet(path).drop("run_at")


@query("scored_results")
def scored_results(spark, d):
    scored = ensemble_table(spark, d)
    out = _details(scored, spark, d).withColumnsRenamed(
        {"ensemble_flag": "is_anomaly_enhanced", "ensemble_score": "anomaly_score_enhanced"}
    )
    path = files.write_scored(out, scratch_dir(spark, "scored"))
    return spark.read.parquet(path).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


@query("model_roundtrip")
def model_roundtrip(spark, d):
    """Saved and loaded models score as the fitted ones do."""
    m, features = matrix(spark, d)
    path = scratch_dir(spark, "models")
    forest = iforest.fit(m, ID, features)
    trees = sup.fit_random_forest(m, features)
    forest.save(spark, f"{path}/iforest")
    trees.write().overwrite().save(f"{path}/random_forest")
    again = sup.score_random_forest(sup.score_random_forest(m, trees, "a"), PipelineModel.load(f"{path}/random_forest"), "b")
    again = iforest.IsolationForest.load(spark, f"{path}/iforest").score(forest.score(again, "c"), "e")
    return again.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.abs(F.col("a") - F.col("b"))).alias("random_forest_gap"),
        F.max(F.abs(F.col("c") - F.col("e"))).alias("isolation_forest_gap"),
    )


@query("feature_importance")
def feature_importance(spark, d):
    """Ten most important features of the forest, names taken from the columns it was fitted on."""
    m, features = matrix(spark, d)
    model = sup.fit_random_forest(m, features)
    return spark.createDataFrame(sup.importances(model, features)[:10], "feature string, importance double")


# --- marts on scores -----------------------------------------------------------------------------------------


@query("anomaly_mart")
def anomaly_mart(spark, d):
    return marts.anomaly_overview(cut(forest_scores(spark, d)))


@query("recent_anomalies")
def recent_anomalies(spark, d):
    recent = marts.recent_anomalies(forest_scores(spark, d).drop("amount"), 20)
    shown = recent.join(src.transactions(spark, d).select(ID, "amount", "merchant_name", "merchant_category"), ID)
    return shown.select(
        ID, "account_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "amount", "merchant_name",
        "merchant_category", "anomaly_score",
    )


@query("txn_detail", f"""WITH {TXN}, {RISK_SQL} SELECT transaction_id, account_id, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, amount, merchant_name, merchant_category,
  rapid_fire, is_night, is_weekend, is_new_merchant, risk_time, risk_amount_anomaly, risk_velocity, risk_new_merchant, risk_score FROM risk WHERE transaction_id = 'txn_00000042'""", "amount risk_score")
def txn_detail(spark, d):
    # Every feature of a transaction comes from its account's rows: only these are worked on.
    t = src.transactions(spark, d)
    own = t.where(F.col(ID) == "txn_00000042").select("account_id").distinct()
    t = profiles.with_risk(cut(t.join(own, "account_id", "left_semi"), "account"))
    return marts.transaction_detail(t, "txn_00000042").withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


# --- explanation ---------------------------------------------------------------------------------------------


def explained(spark, d):
    m, features = matrix(spark, d)
    scored = cut(iforest.fit(m, ID, features).score(m))
    model, split = sup.fit_surrogate(scored, features, "anomaly_score")
    trees = ex.tree_sum(model, features, spark)
    return trees.explain(split), trees, model


@query("explain_background", f"WITH {TXN} SELECT transaction_id, amount FROM txn ORDER BY md5(concat(transaction_id, '42')) LIMIT 100", "amount")
def explain_background(spark, d):
    """The explanation's background sample."""
    return ex.background(src.transactions(spark, d), ID).select(ID, "amount")


@query("surrogate_fit")
def surrogate_fit(spark, d):
    m, features = matrix(spark, d)
    scored = cut(iforest.fit(m, ID, features).score(m))
    model, split = sup.fit_surrogate(scored, features, "anomaly_score")
    return sup.accuracy(model, split)


@query("explain_contributions")
def explain_contributions(spark, d):
    rows, trees, _ = explained(spark, d)
    return rows.select(ID, F.lit(trees.base).alias("base_value"), F.explode("contributions").alias("c")).select(
        ID, "base_value", "c.feature", "c.contribution", "c.value"
    )


@query("explain_topk")
def explain_topk(spark, d):
    rows, trees, _ = explained(spark, d)
    return rows.select(ID, F.posexplode(ex.top_factors("contributions", 10)).alias("place", "c")).select(
        ID, "place", "c.feature", "c.contribution", "c.value"
    )


@query("explain_global")
def explain_global(spark, d):
    return ex.global_importance(explained(spark, d)[0])


@query("alert_text")
def alert_text(spark, d):
    rows = explained(spark, d)[0].filter(F.col("label") == 1)
    return ex.alert_text(_details(rows, spark, d)).select(ID, "alert_text")
