"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from catalog import views
from flowtide.functions import stamp, stats
from flowtide.operators import cluster, features, flows, prep, profile, rules, score, sketches, thresholds, versions
from flowtide.plans import block_anomalies, block_exceedances, fit_detector
from flowtide.schemas import FEATURES, MODEL, MODEL_FEATURES, RAW_FLOW
from flowtide.session import materialize, new_folder
from flowtide.sinks import append_features, append_rules, compact_day, export_csv
from flowtide.sources import (
    checked_feature_csv, decode, read_feature_csv, read_flow_json, read_hosts, read_lines, read_rules, read_store,
)
from flowtide.streaming import (
    FlowCounts, each_arrival, joined_features, keep_every_flow, read_aside, read_mark, read_open, read_windows, run_available, score_stream,
    score_windows, store_features, store_rules, valid_stream, windowed_features, windowed_sketches, write_table,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

DAY = ("win", "srcAddr")
VOLUME_KEYS = ("win", "srcAddr")
BINS = 10
# Training centres of the checkable model: the mean, and one deviation to either side.
OFFSETS = (-1.0, 0.0, 1.0)


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = build
    return build


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def volume_features(spark: SparkSession, folder: str) -> DataFrame:
    return features.features_by_source(views.volume_flows(spark, folder), VOLUME_KEYS)


def stored_volume(spark: SparkSession, folder: str) -> DataFrame:
    """The volume features as a written table, for work that reads them more than once."""
    return materialize(volume_features(spark, folder), "features")


def spread(df: DataFrame, array: str, columns=MODEL_FEATURES) -> list:
    return [F.col(array)[i].alias(f"{array}_{c}") for i, c in enumerate(columns)]


# --- flows -----------------------------------------------------------------------------


@query
def flow_projection(spark, folder):
    return flows.project_flows(views.raw_events(spark, folder))


@query
def flow_decode(spark, folder):
    decoded = flows.project_flows(decode(views.messages(spark, folder)))
    return flows.valid_flows(decoded)


@query
def flow_decode_all(spark, folder):
    """Every one of the 40 keys of a record, decoded from messages that hold them all."""
    keys = RAW_FLOW.fieldNames()
    full = views.raw_events(spark, folder).select(*[
        F.col(k) if k in views.EVENT_KEYS
        else (F.concat(F.lit(k), F.col("srcport").cast("string")) if isinstance(RAW_FLOW[k].dataType, T.StringType)
              else F.col("srcport") * 100 + F.lit(keys.index(k))).alias(k) for k in keys])
    text = full.select(F.to_json(F.struct(*keys)).alias("value"))
    return decode(text, keys, ())


@query
def event_stamp(spark, folder):
    """The event time of each flow as text."""
    return views.event_flows(spark, folder).select("srcAddr", "srcPort", "timestampStart", stamp(F.col("eventTime")).alias("stamp"))


@query
def flow_rejects(spark, folder):
    decoded = flows.project_flows(decode(views.messages(spark, folder)), keep=("value",))
    return flows.rejected_flows(decoded).select("value", "reason")


@query
def flow_l4_ports(spark, folder):
    return flows.with_l4_ports(flows.project_flows(views.raw_events(spark, folder)))


@query
def flow_json_lines(spark, folder):
    """Messages written as text lines, read back as lines and as JSON records."""
    path = new_folder(spark, "lines")
    views.messages(spark, folder).write.text(path)
    lines = read_lines(spark, path).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("characters"))
    records = flows.valid_flows(flows.project_flows(read_flow_json(spark, path))).agg(
        F.count(F.lit(1)).alias("records"), F.sum("numBytes").alias("bytes"))
    sides = [lines.select(F.struct("*").alias("s")).scalar(),
             records.select(F.struct("*").alias("s")).scalar()]
    return spark.range(1).select(sides[0].alias("l"), sides[1].alias("r")).select("l.*", "r.*")


# --- features --------------------------------------------------------------------------


@query
def features_by_source(spark, folder):
    """Features per minute and source: the flagship."""
    return views.event_features(spark, folder, "60 seconds")


@query
def features_whole_batch(spark, folder):
    """All events as one batch, as an arrival batch sees them."""
    return features.features_by_source(views.event_flows(spark, folder))


@query
def features_volume(spark, folder):
    return volume_features(spark, folder)


@query
def features_l4_ports(spark, folder):
    return features.features_by_source(flows.with_l4_ports(views.event_flows(spark, folder)))


@query
def features_inner_join(spark, folder):
    return features.features_by_join(views.volume_flows(spark, folder), VOLUME_KEYS)


@query
def features_outer_join(spark, folder):
    return features.model_features_by_join(views.volume_flows(spark, folder), VOLUME_KEYS)


@query
def pair_counts(spark, folder):
    return features.pair_counts(views.event_flows(spark, folder), "dstAddr")


@query
def bytes_per_flow(spark, folder):
    rates = features.flow_rates(views.event_flows(spark, folder))
    return rounded(rates, 4, "bytesPerFlow").select("srcAddr", "bytesPerFlow")


@query
def comm_time(spark, folder):
    rates = features.flow_rates(views.event_flows(spark, folder))
    return rounded(rates, 4, "avgCommTime").select("srcAddr", "commTime", "avgCommTime")


# --- profile ---------------------------------------------------------------------------


@query
def column_stats(spark, folder):
    stats = profile.column_stats(volume_features(spark, folder), FEATURES)
    return rounded(rounded(stats, 3, "mean", "stddev"), 0, "variance")


@query
def describe(spark, folder):
    return rounded(profile.describe(stored_volume(spark, folder), FEATURES),
                   3, "mean", "stddev", "q25", "q50", "q75")


@query
def value_counts(spark, folder):
    return profile.value_counts(volume_features(spark, folder), "uniqDstPorts")


@query
def value_counts_top(spark, folder):
    """The ten most frequent values."""
    return profile.value_counts(volume_features(spark, folder), "uniqDstPorts", top=10)


@query
def histogram(spark, folder):
    bins = profile.histogram(volume_features(spark, folder), "uniqDstIPs", BINS)
    return rounded(bins, 6, "low", "high")


@query
def correlation(spark, folder):
    return rounded(profile.correlation_matrix(volume_features(spark, folder), FEATURES),
                   6, "correlation")


@query
def quality_report(spark, folder):
    decoded = flows.project_flows(decode(views.messages(spark, folder)))
    return profile.quality_report(decoded, ("numBytes", "numFlows", "dstPort", "tcpFlags"))


@query
def null_rows(spark, folder):
    decoded = flows.project_flows(decode(views.messages(spark, folder)))
    return profile.null_rows(decoded, "numFlows").select("srcAddr", "dstAddr", "dstPort", "numFlows")


@query
def zero_rows(spark, folder):
    decoded = flows.project_flows(decode(views.messages(spark, folder)))
    return profile.zero_rows(decoded, "tcpFlags").select(
        "srcAddr", "dstAddr", "dstPort", "tcpFlags", "timestampStart")


@query
def outlier_filter(spark, folder):
    kept = profile.exclude_values(volume_features(spark, folder), "uniqDstPorts", (1, 2, 3))
    return kept.select("win", "srcAddr", "uniqDstPorts")


@query
def shape(spark, folder):
    return profile.shape(volume_features(spark, folder))


def stored_days(spark: SparkSession, folder: str) -> DataFrame:
    """The features of days as a written table, likewise."""
    return materialize(views.event_features(spark, folder), "days")


def gapped(volume: DataFrame) -> DataFrame:
    """Volume features as doubles, a fifth of the values missing, as NaN or null."""
    def value(c: str):
        missing = F.when(F.col(c) % 2 == 0, F.lit(float("nan")))
        return F.when(F.col(c) % 5 == 0, missing).otherwise(F.col(c).cast("double")).alias(c)

    return volume.select(*VOLUME_KEYS, *[value(c) for c in FEATURES])


@query
def value_counts_gaps(spark, folder):
    return profile.value_counts(gapped(volume_features(spark, folder)), "uniqDstPorts")


@query
def correlation_gaps(spark, folder):
    return rounded(profile.correlation_matrix(gapped(volume_features(spark, folder)), FEATURES), 6, "correlation")


@query
def quality_report_text(spark, folder):
    """Missing values of text columns and of columns with NaN."""
    decoded = flows.project_flows(decode(views.messages(spark, folder)))
    texts = profile.quality_report(decoded, ("srcAddr", "dstAddr"))
    return texts.unionByName(profile.quality_report(gapped(volume_features(spark, folder)), FEATURES))


@query
def sigma_thresholds_gaps(spark, folder):
    limits = thresholds.sigma_thresholds(gapped(volume_features(spark, folder)))
    return rounded(limits, 3, "mean", "stddev", "upper")


@query
def standardize_gaps(spark, folder):
    scaled = prep.standardize(gapped(stored_volume(spark, folder)), FEATURES)
    return rounded(scaled, 6, *FEATURES).select(*VOLUME_KEYS, *FEATURES)


# --- preparation -----------------------------------------------------------------------


@query
def standardize_sample(spark, folder):
    scaled = prep.standardize(stored_days(spark, folder), FEATURES)
    return rounded(scaled, 6, *FEATURES).select(*DAY, *FEATURES)


@query
def standardize_pop(spark, folder):
    scaled = prep.standardize(stored_days(spark, folder), FEATURES, sigma="population")
    return rounded(scaled, 6, *FEATURES).select(*DAY, *FEATURES)


@query
def scale_only(spark, folder):
    scaled = prep.standardize(stored_days(spark, folder), MODEL_FEATURES, center=False)
    return rounded(scaled, 6, *MODEL_FEATURES).select(*DAY, *MODEL_FEATURES)


@query
def interactions(spark, folder):
    """Products of features, without the all-zero column and the products of the id."""
    rows = stored_volume(spark, folder).select(
        F.col("srcAddr").cast("bigint").alias("id"), *MODEL_FEATURES,
        (F.col("sumOfFlows") - F.col("numRecords")).alias("extraFlows"))
    return prep.add_interactions(rows)


@query
def feature_scores(spark, folder):
    """ANOVA F of features and their products against the label."""
    scores = prep.anova_f(labelled_features(spark, folder), LABELLED, "label")
    return rounded(scores, 4, "f_value")


@query
def feature_select(spark, folder):
    """Mean of the three best of six columns."""
    rows = materialize(labelled_features(spark, folder), "labelled")
    best = prep.select_k_best(rows, LABELLED, "label", k=3)
    stats = profile.column_stats(rows, best).select("feature", "count", "mean")
    return rounded(stats, 2, "mean")


LABELLED = (*MODEL_FEATURES, "sumOfBytes_uniqDstIPs", "sumOfBytes_uniqDstPorts",
            "uniqDstIPs_uniqDstPorts")


def labelled_features(spark: SparkSession, folder: str) -> DataFrame:
    """Volume features and their products; the label is the nation of the supplier."""
    rows = prep.interactions(volume_features(spark, folder), MODEL_FEATURES)
    nations = views.table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("srcAddr"), F.col("s_nationkey").alias("label"))
    return rows.join(nations, "srcAddr")


@query
def sample_split(spark, folder):
    """Which line items a 10 % sample and an 80/20 split hold, as counts and sums of their keys."""
    keys = ("l_orderkey", "l_linenumber")
    rows = views.table(spark, folder, "lineitem").select(*[F.col(k).cast("bigint").alias(k) for k in keys])
    train, test = prep.train_test_split(rows, keys=keys)
    parts = {"sample": prep.bernoulli_sample(rows, keys=keys), "train": train, "test": test}
    named = [part.select(F.lit(name).alias("part"), *keys) for name, part in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2]).groupBy("part").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("keys"))


@query
def row_ids(spark, folder):
    """Every row has an id of its own."""
    rows = prep.add_row_id(views.event_flows(spark, folder))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"))


# --- thresholds and detectors ----------------------------------------------------------


@query
def sigma_thresholds(spark, folder):
    limits = thresholds.sigma_thresholds(volume_features(spark, folder))
    return rounded(limits, 3, "mean", "stddev", "upper")


def daily_limits(spark: SparkSession, folder: str) -> dict[str, float]:
    return score.upper_limits(thresholds.sigma_thresholds(views.event_features(spark, folder)))


@query
def sigma_detector(spark, folder):
    """Weeks judged by what was normal for a day."""
    live = views.event_features(spark, folder, "7 days")
    return score.exceedances(live, daily_limits(spark, folder), keys=DAY)


@query
def sigma_detector_join(spark, folder):
    live = views.event_features(spark, folder, "7 days")
    return score.exceedances_by_join(live, daily_limits(spark, folder), keys=DAY)


def assigned_days(spark: SparkSession, folder: str, scale: bool = True):
    """Daily features, scaled or raw, assigned to centres on the mean and one deviation off."""
    raw = materialize(
        prep.as_double(views.event_features(spark, folder), MODEL_FEATURES), "days")
    prepared = prep.standardize(raw, MODEL_FEATURES, center=False) if scale else raw
    moments = prepared.agg(*thresholds.moments_of(MODEL_FEATURES)).first()
    centers = [[m + z * s for m, s in zip(moments["mean"], moments["stddev"])] for z in OFFSETS]
    return cluster.assign(prepared, MODEL_FEATURES, centers), centers, raw


def day_model(spark: SparkSession, folder: str, scale: bool = True) -> list[dict]:
    assigned, centers, raw = assigned_days(spark, folder, scale)
    limits = {r["cluster"]: r["threshold"]
              for r in thresholds.cluster_thresholds(assigned).collect()}
    moments = raw.agg(*thresholds.moments_of(MODEL_FEATURES)).first().asDict()
    return [{"cluster": i, "center": c, "threshold": limits.get(i), **moments}
            for i, c in enumerate(centers)]


@query
def nearest_center(spark, folder):
    assigned, _, _ = assigned_days(spark, folder)
    return rounded(assigned, 6, "distance").select(*DAY, "cluster", "distance")


@query
def rows_of_cluster(spark, folder):
    """The days nearest to the middle centre."""
    assigned, _, _ = assigned_days(spark, folder)
    return cluster.rows_of_cluster(assigned, 1).select(*DAY, "cluster")


@query
def vector_columns(spark, folder):
    """Features put into a vector and taken out again."""
    vectors = prep.assemble(views.event_features(spark, folder), MODEL_FEATURES)
    return vectors.select(*DAY, *stats.vector_columns("features", MODEL_FEATURES))


@query
def labelled_rows(spark, folder):
    """Assignments joined back to the raw features they came from."""
    assigned, _, raw = assigned_days(spark, folder)
    return (assigned.select(*DAY, "cluster").join(raw, list(DAY))
            .select(*DAY, "cluster", *MODEL_FEATURES))


@query
def silhouette_days(spark, folder):
    """Silhouette of the checkable assignment."""
    assigned, _, _ = assigned_days(spark, folder)
    value = cluster.silhouette(prep.assemble(assigned, MODEL_FEATURES))
    sizes = cluster.cluster_sizes(assigned)
    return sizes.agg(F.count(F.lit(1)).alias("clusters"), F.sum("rows").alias("rows")).withColumn(
        "silhouette", F.round(F.lit(float(value)), 6))


@query
def model_costs(spark, folder):
    """WSSSE and distortion of one and of three given centres, in one pass."""
    assigned, centers, _ = assigned_days(spark, folder)
    models = {1: cluster.mean_center(assigned, MODEL_FEATURES), 3: centers}
    costs = cluster.costs(assigned, MODEL_FEATURES, models).withColumnRenamed("model", "k")
    return rounded(costs, 6, "wssse", "distortion")


@query
def cluster_sizes(spark, folder):
    return cluster.cluster_sizes(assigned_days(spark, folder)[0])


@query
def cluster_stats(spark, folder):
    stats = thresholds.cluster_stats(assigned_days(spark, folder)[0])
    flat = stats.select("cluster", "rows", *spread(stats, "feature_max"), *spread(stats, "mean"),
                        *spread(stats, "stddev"))
    return rounded(flat, 6, *flat.columns[2:])


@query
def overall_stats(spark, folder):
    """Mean and deviation over all clusters, raw and scaled."""
    scaled, _, raw = assigned_days(spark, folder)

    def row(df, name, digits):
        stats = df.agg(*thresholds.moments_of(MODEL_FEATURES))
        flat = stats.select(F.lit(name).alias("data"), *spread(stats, "mean"),
                            *spread(stats, "stddev"))
        return rounded(flat, digits, *flat.columns[1:])

    return row(raw, "raw", 3).unionByName(row(scaled, "scaled", 6))


@query
def cluster_thresholds(spark, folder):
    limits = thresholds.cluster_thresholds(assigned_days(spark, folder)[0])
    flat = limits.select("cluster", *spread(limits, "upper"), "threshold")
    return rounded(flat, 6, *flat.columns[1:])


@query
def cluster_thresholds_v1(spark, folder):
    limits = thresholds.cluster_thresholds_by_spread(assigned_days(spark, folder)[0])
    flat = limits.select("cluster", *spread(limits, "upper"), "threshold")
    return rounded(flat, 6, "threshold")


@query
def anomalies(spark, folder):
    """Weeks scored by a model of days, with live rows centred and not."""
    live = views.event_features(spark, folder, "7 days")
    model = day_model(spark, folder)

    def scored(name, **how):
        return (score.score(live, model, **how).withColumn("setting", F.lit(name))
                .select("setting", *DAY, "cluster", "distance", "anomaly"))

    both = scored("centred").unionByName(scored("uncentred", center=False))
    return rounded(both, 6, "distance")


@query
def anomalies_unscaled(spark, folder):
    live = views.event_features(spark, folder, "7 days")
    scored = score.score(live, day_model(spark, folder, scale=False), scale=False)
    return rounded(scored, 3, "distance").select(*DAY, "cluster", "distance", "anomaly")


@query
def anomalies_v1(spark, folder):
    """Weeks scored by the earlier model, built and applied on raw features."""
    assigned, centers, _ = assigned_days(spark, folder, scale=False)
    found = {r["cluster"]: r.asDict()
             for r in thresholds.cluster_thresholds_by_spread(assigned).collect()}
    model = [{"cluster": i, "center": c, "mean": None, "stddev": None, "threshold": None,
              **found.get(i, {})} for i, c in enumerate(centers)]
    live = views.event_features(spark, folder, "7 days")
    return rounded(score.score_by_sign(live, model), 3, "distance").select(
        *DAY, "cluster", "distance", "anomaly")


# --- rules -----------------------------------------------------------------------------


@query
def host_lookup(spark, folder):
    days = views.event_features(spark, folder).select(*DAY)
    return rules.host_lookup(days, views.hosts(spark, folder)).select(*DAY, "device", "status")


@query
def host_files(spark, folder):
    """Host documents written as lines of text, read back as an inventory."""
    path = new_folder(spark, "hosts")
    views.host_documents(spark, folder).write.text(path)
    return read_hosts(spark, path, multi_line=False)


@query
def drop_rules(spark, folder):
    """Rules for the weeks beyond a daily limit."""
    live = views.event_features(spark, folder, "7 days")
    return block_exceedances(live, daily_limits(spark, folder), views.hosts(spark, folder),
                             keys=("win",))


@query
def anomaly_rules(spark, folder):
    """Rules for the weeks beyond the threshold of their cluster."""
    live = views.event_features(spark, folder, "7 days")
    return block_anomalies(live, day_model(spark, folder), views.hosts(spark, folder),
                           keys=("win",), center=False)


# --- models ----------------------------------------------------------------------------


@query
def kmeans_fit(spark, folder):
    """Scale, fit and derive thresholds on monthly volume: raw moments, and what a fit must satisfy."""
    source = stored_volume(spark, folder)
    return fit_facts(source, "scaled").unionByName(fit_facts(source, "raw", scale=False)).unionByName(
        fit_facts(source, "by_spread", by_spread=True))


def fit_facts(source: DataFrame, name: str, **how) -> DataFrame:
    """Rows, moments, and counts of violations of one training: centres away from the mean of their rows by over
    a tenth of a deviation, thresholds or maxima other than those of the assignment, clusters without rows."""
    spark = source.sparkSession
    model = fit_detector(source, **how)
    rows = prep.as_double(source.select(*MODEL_FEATURES), MODEL_FEATURES)
    moments = rows.agg(*thresholds.moments_of(MODEL_FEATURES))
    if how.get("scale", True):
        rows = prep.standardize(rows, MODEL_FEATURES, center=False)
    fitted = sorted(model.collect(), key=lambda r: r["cluster"])
    assigned = cluster.assign(rows, MODEL_FEATURES, [r["center"] for r in fitted])
    by = thresholds.cluster_thresholds_by_spread if how.get("by_spread") else thresholds.cluster_thresholds
    limits = {r["cluster"]: r for r in by(assigned).collect()}
    stats = {r["cluster"]: r for r in thresholds.cluster_stats(assigned).collect()}
    scale = rows.agg(*thresholds.moments_of(MODEL_FEATURES)).first()["stddev"]
    near = lambda a, b: abs(a - b) <= 1e-6 * max(1.0, abs(a), abs(b))
    off = sum(abs(c - m) > 0.1 * s for r in fitted if r["cluster"] in stats
              for c, m, s in zip(r["center"], stats[r["cluster"]]["mean"], scale))
    wrong = sum(not near(r["threshold"], limits[r["cluster"]]["threshold"]) for r in fitted if r["cluster"] in limits)
    facts = spark.createDataFrame(
        [(name, len(fitted), sum(r["rows"] for r in stats.values()), len(fitted) - len(stats), off, wrong)],
        "training string, clusters int, rows long, empty int, centers_off int, thresholds_off int")
    flat = moments.select(*spread(moments, "mean"), *spread(moments, "stddev"))
    return facts.crossJoin(rounded(flat, 3, *flat.columns))  # one row each


def scaled_volume(spark: SparkSession, folder: str) -> DataFrame:
    """Scaled as it is read: the moments come from the written table, which is not written again."""
    rows = prep.as_double(stored_volume(spark, folder).select(*MODEL_FEATURES), MODEL_FEATURES)
    return prep.standardize(rows, MODEL_FEATURES, center=False)


@query
def silhouette(spark, folder):
    vectors = prep.assemble(scaled_volume(spark, folder), MODEL_FEATURES)
    model = cluster.fit_kmeans(vectors, 3, 1)
    assigned = model.transform(vectors)
    value = cluster.silhouette(assigned)
    return cluster.silhouette_by_sums(assigned, MODEL_FEATURES).select(
        F.lit(3).alias("k"), "rows", (F.abs(F.col("silhouette") - F.lit(value)) < 1e-6).alias("agrees"))


@query
def weighted_costs(spark, folder):
    """Costs of given centres over the distinct vectors and their weights: those of all rows."""
    pairs = ("uniqDstIPs", "uniqDstPorts")
    rows = prep.as_double(stored_volume(spark, folder).select(*pairs), pairs)
    vectors = cluster.weighted_vectors(rows, pairs)
    models = {1: [[2.0, 3.0]], 3: [[1.0, 1.0], [4.0, 4.0], [9.0, 10.0]]}
    found = cluster.costs(vectors, pairs, models, cluster.WEIGHT).withColumnRenamed("model", "k")
    facts = vectors.agg(F.struct(F.count(F.lit(1)).alias("vectors"), F.sum(cluster.WEIGHT).alias("rows")).alias("f")).scalar()
    return rounded(found, 6, "wssse", "distortion").withColumn("f", facts).select("k", "wssse", "distortion", "f.vectors", "f.rows")


@query
def sample_repeated(spark, folder):
    """A tenth and the parts of a split of rows that repeat: sources per destination port, drawn without a key."""
    rows = views.event_flows(spark, folder).select("srcAddr", "protocol")
    train, test = prep.train_test_split(rows)
    parts = {"sample": prep.bernoulli_sample(rows), "train": train, "test": test}
    named = [p.groupBy("srcAddr", "protocol").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("part"), "*")
             for n, p in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query
def elbow_wssse(spark, folder):
    """k = 2..19, fitted on a 10 % sample, cost over all rows as worked out row by row, none above that of one centre."""
    rows = scaled_volume(spark, folder)
    return below_one_center(rows, elbow_checked(rows, "wssse"), "wssse").select("k", "rows", "one_center", "below", "agrees")


def elbow_checked(rows: DataFrame, measure: str, *how) -> DataFrame:
    """An elbow curve with whether its costs are those of its centres, worked out for each row."""
    vectors, models = cluster.elbow_models(rows, MODEL_FEATURES, *how)
    curve = cluster.costs(vectors, MODEL_FEATURES, models, cluster.WEIGHT).withColumnRenamed("model", "k")
    centers = {k: m if isinstance(m, list) else cluster.centers_of(m) for k, m in models.items()}
    plain = cluster.costs_by_row(rows, MODEL_FEATURES, centers).select(F.col("model").alias("k"), F.col(measure).alias("plain"))
    return curve.join(plain, "k").withColumn(
        "agrees", F.abs(F.col(measure) - F.col("plain")) <= F.lit(1e-9) * F.greatest(F.lit(1.0), F.abs("plain")))


def below_one_center(rows: DataFrame, curve: DataFrame, measure: str) -> DataFrame:
    """Rows covered, the cost of one centre, and whether each cost is at most that."""
    one = cluster.costs(rows, MODEL_FEATURES, {1: cluster.mean_center(rows, MODEL_FEATURES)}).first()[measure]
    total = rows.agg(F.count(F.lit(1)).alias("rows")).scalar()
    return curve.withColumns({"rows": total, "one_center": F.round(F.lit(one), 4),
                              "below": F.col(measure) <= F.lit(one * (1 + 1e-9))})


@query
def elbow_distortion(spark, folder):
    """k = 1..9, fitted on all rows; k = 1 exactly."""
    rows = scaled_volume(spark, folder)
    curve = below_one_center(rows, elbow_checked(rows, "distortion", range(1, 10), None), "distortion")
    return curve.select("k", "rows", "one_center", "below", "agrees", F.when(F.col("k") == 1, F.round("distortion", 4)).alias("first"))


@query
def elbow_iterations(spark, folder):
    """Random starts over the whole grid of iteration limits and k."""
    rows = scaled_volume(spark, folder)
    grid = below_one_center(rows, cluster.iteration_grid(rows, MODEL_FEATURES), "wssse")
    return grid.select("max_iter", "k", "rows", "one_center", "below", F.when(F.col("k") == 1, F.round("wssse", 4)).alias("first"))


# --- stores and streams ----------------------------------------------------------------


@query
def csv_roundtrip(spark, folder):
    path = new_folder(spark, "csv")
    export_csv(volume_features(spark, folder), path)
    return read_feature_csv(spark, path)


@query
def csv_rejects(spark, folder):
    """Lines of features, four of seven spoilt, read back: the rows, and the lines set aside with their reason."""
    text = [F.col(c).cast("string") for c in MODEL_FEATURES]
    kind = F.col("sumOfBytes") % 7
    line = (F.when(kind == 0, F.concat_ws(",", F.lit("abc"), *text[1:])).when(kind == 1, F.concat_ws(",", *text[:2]))
            .when(kind == 2, F.concat_ws(",", *text, F.lit("9"))).when(kind == 3, F.concat_ws(",", text[0], F.lit(""), text[2]))
            .otherwise(F.concat_ws(",", *text)))
    path = new_folder(spark, "spoilt")
    volume_features(spark, folder).select(line.alias("value")).write.text(path)
    good, rejected = checked_feature_csv(spark, path)
    return good.unionByName(rejected, allowMissingColumns=True)


@query
def feature_store_append(spark, folder):
    """Two writers with the same batch number, one replayed, one replayed on fewer days; a range of days."""
    return stored(read_store(spark, filled_store(spark, folder), since="2024-01-05", until="2024-01-20"))


@query
def feature_store_compacted(spark, folder):
    """The whole store after two of its days were compacted, one of them twice."""
    path = filled_store(spark, folder)
    for day, keep in (("2024-01-07", 0), ("2024-01-08", 1), ("2024-01-07", 0)):
        compact_day(spark, path, day, keep)
    return stored(read_store(spark, path))


def stored(store: DataFrame) -> DataFrame:
    return store.select("writer", "batch", F.col("day").cast("string").alias("day"), *FEATURES)


def filled_store(spark: SparkSession, folder: str) -> str:
    path = new_folder(spark, "store")
    minutes = materialize(views.event_features(spark, folder, "60 seconds"), "minutes")
    days = materialize(views.event_features(spark, folder), "days")
    early = days.filter("win < timestamp_ntz'2024-01-10'")
    for writer, batch, rows in (("a", 0, minutes), ("b", 0, days), ("a", 1, days), ("a", 1, days),
                                ("c", 0, days), ("c", 0, early)):
        append_features(rows, batch, path, writer)
    return path


@query
def rule_store_append(spark, folder):
    """Rules of two writers, one batch replayed; then those of all weeks that are not yet written."""
    path = new_folder(spark, "rules")
    found = drop_rules(spark, folder)
    first = found.filter("win < timestamp_ntz'2024-01-14'")
    for writer, batch in (("a", 0), ("b", 0), ("a", 0)):
        append_rules(first, batch, path, writer)
    columns = ["writer", "batch", *found.columns]
    kept = read_rules(spark, path).select(*columns)
    fresh = rules.not_written(found, kept).withColumns({"writer": F.lit("new"), "batch": F.lit(-1)})
    return kept.unionByName(fresh.select(*columns)).withColumn("batch", F.col("batch").cast("bigint"))


def stream_result(spark: SparkSession, stream: DataFrame) -> DataFrame:
    base = new_folder(spark, "stream")
    run_available(write_table(stream, f"{base}/table", f"{base}/checkpoint",
                              state_partitions=spark.sparkContext.defaultParallelism))
    return spark.read.schema(stream.schema).parquet(f"{base}/table")


@query
def stream_features(spark, folder):
    """Minutes closed by the watermark."""
    flow_stream = valid_stream(views.message_stream(spark, folder))
    return views.plain_window(stream_result(spark, windowed_features(flow_stream)))


@query
def stream_joined(spark, folder):
    """Hours closed by the watermark, as a full outer join of two aggregated streams."""
    flow_stream = valid_stream(views.message_stream(spark, folder))
    return views.plain_window(stream_result(spark, joined_features(flow_stream, "1 hour")))


@query
def stream_anomalies(spark, folder):
    """Closed days of the stream, scored with a model of days."""
    live = windowed_features(valid_stream(views.message_stream(spark, folder)), "1 day")
    scored = score_stream(live, day_model(spark, folder), center=False)
    result = views.plain_window(stream_result(spark, scored))
    return rounded(result, 6, "distance").select(*DAY, "cluster", "distance", "anomaly")


@query
def stream_rules(spark, folder):
    """Rules for the closed weeks of the stream that the model of days finds anomalous."""
    live = windowed_features(valid_stream(views.message_stream(spark, folder)), "7 days")
    found = block_anomalies(live, day_model(spark, folder), views.hosts(spark, folder),
                            keys=("win",), center=False)
    return views.plain_window(stream_result(spark, found))


@query
def stream_arrival(spark, folder):
    """The events of one arrival batch, appended to the feature store."""
    base = new_folder(spark, "arrival")
    flow_stream = valid_stream(views.message_stream(spark, folder))
    run_available(each_arrival(flow_stream, [store_features(f"{base}/store", "arrivals")],
                               f"{base}/checkpoint", every=None))
    return read_store(spark, f"{base}/store").select("batch", *FEATURES)


@query
def stream_arrival_seconds(spark, folder):
    """The same with a trigger every second, stopped when all has been read."""
    base = new_folder(spark, "arrival")
    running = each_arrival(valid_stream(views.message_stream(spark, folder)), [store_features(f"{base}/store", "seconds")],
                           f"{base}/checkpoint", every="1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return read_store(spark, f"{base}/store").select("batch", *FEATURES)


def days_in_parts(spark: SparkSession, folder: str, work=()) -> str:
    """Days of the messages in their parts, the stream started anew for every part; the folder of the results."""
    base = new_folder(spark, "parts")
    arrivals = views.arrivals(spark, folder)  # a part's messages are made when it arrives, and written once
    for part in sorted(r["part"] for r in arrivals.select("part").distinct().collect()):  # a handful of parts
        arrivals.filter(F.col("part") == part).drop("part").write.mode("append").parquet(f"{base}/inbox")
        stream = spark.readStream.schema(arrivals.drop("part").schema).parquet(f"{base}/inbox")
        run_available(keep_every_flow(stream, f"{base}/flows", f"{base}/checkpoint", "1 day", "6 hours", every=None, work=work))
    return f"{base}/flows"


@query
def stream_hold_off(spark, folder):
    """Rules for closed days beyond a limit, one per source in three days, over several batches and restarts."""
    rules_path = new_folder(spark, "held-rules")
    hosts = views.hosts(spark, folder)
    judge = lambda days: block_exceedances(days, {"sumOfFlows": 5.0}, hosts, ("win",), ("sumOfFlows",))
    days_in_parts(spark, folder, [store_rules(rules_path, judge, "held", hold="3 days")])
    return views.plain_window(read_rules(spark, rules_path).drop("writer", "batch"))


@query
def stream_late(spark, folder):
    """Days of a stream that comes in parts, some flows after their day was closed, some dated far ahead.

    The query is started anew for every part. Closed and open windows, late flows by window, rejected messages by
    reason, and the counts of the stream.
    """
    result = days_in_parts(spark, folder)
    late = read_aside(spark, result, "late").groupBy("win", "srcAddr").agg(
        F.sum("numFlows").alias("sumOfFlows"), F.sum("numBytes").alias("sumOfBytes"), F.count(F.lit(1)).alias("numRecords"))
    rejected = read_aside(spark, result, "rejected").groupBy("reason").agg(F.count(F.lit(1)).alias("numRecords"))
    mark = read_mark(spark, result)
    counts = spark.createDataFrame([(c, mark[c]) for c in ("read", "timely", "late", "rejected")], "reason string, numRecords long")
    columns = ["win", "srcAddr", *FEATURES, "numRecords", "reason"]
    tables = {"window": read_windows(spark, result), "open": read_open(spark, result), "late": late,
              "rejected": rejected, "count": counts}
    rows = None
    for kind, table in tables.items():
        own = views.plain_window(table) if "win" in table.columns else table
        own = own.select(F.lit(kind).alias("kind"), *[c for c in columns if c in own.columns])
        rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
    return rows.select("kind", *columns)


@query
def flow_counts(spark, folder):
    """What a batch job and a stream read, passed on and rejected, observed while they write."""
    seen = Observation()
    decoded = flows.project_flows(decode(views.messages(spark, folder)))
    flows.counted_flows(decoded, seen).write.format("noop").mode("overwrite").save()
    listener = FlowCounts("flows")
    spark.streams.addListener(listener)
    try:
        stream = write_table(valid_stream(views.message_stream(spark, folder), counts="flows"),
                             f"{new_folder(spark, 'counted')}/table", f"{new_folder(spark, 'counted')}/checkpoint")
        run_available(stream)
        listener.wait(stream.id)
    finally:
        spark.streams.removeListener(listener)
    names = ("read", "valid", "unreadable", "missing", "ahead")
    return spark.createDataFrame(
        [("batch", *[seen.get[n] for n in names]), ("stream", *[listener.totals[n] for n in names])],
        "job string, " + ", ".join(f"{n} long" for n in names))


# Fixed models in force one after the other: since, (centre, threshold) of each cluster, mean, deviation.
GIVEN_VERSIONS = (
    ("2024-01-03", (((0.5, 0.5, 0.5), 0.5), ((2.0, 1.0, 1.0), 1.5)), (20000.0, 10.0, 3.0), (20000.0, 10.0, 0.0)),
    ("2024-01-12", (((0.0, 1.0, 0.0), 0.25), ((1.0, 0.0, 1.0), None)), (1000.0, 2.0, 1.0), (50000.0, 5.0, 2.0)),
    ("2024-01-19", (((0.1, 0.1, 0.1), 2.0),), (5000.0, 4.0, 2.0), (9000.0, 3.0, 2.0)),
)


def save_given_version(spark: SparkSession, path: str, number: int) -> None:
    since, clusters, mean, stddev = GIVEN_VERSIONS[number]
    rows = [(i, list(c), None, list(mean), list(stddev), t) for i, (c, t) in enumerate(clusters)]
    versions.save_version(spark.createDataFrame(rows, MODEL), path, since)


def decisions(scored: DataFrame) -> DataFrame:
    plain = scored.withColumn("since", F.col("since").cast("timestamp_ntz"))
    return rounded(plain, 6, "distance").select(*DAY, "since", "cluster", "distance", "anomaly")


@query
def anomalies_by_version(spark, folder):
    """All days, each scored by the one of three models that was in force."""
    path = new_folder(spark, "versions")
    for number in range(len(GIVEN_VERSIONS)):
        save_given_version(spark, path, number)
    return decisions(versions.score_in_force(
        views.event_features(spark, folder), versions.load_versions(spark, path), "win"))


@query
def stream_model_change(spark, folder):
    """Closed days of a stream in parts; models are replaced before the second and the third part."""
    models, scored = new_folder(spark, "versions"), new_folder(spark, "scored")

    def change(features: DataFrame, number: int) -> None:
        if number < len(GIVEN_VERSIONS):
            save_given_version(spark, models, number)

    days_in_parts(spark, folder, [change, score_windows(models, scored)])
    return decisions(views.plain_window(spark.read.parquet(scored)))


def judged_sketches(exact: DataFrame, merged: DataFrame) -> DataFrame:
    """Sums of merged sketches, and whether their estimates are within three standard errors of the exact counts."""
    counts = exact.select(*DAY, *[F.col(c).alias(f"exact_{c}") for c in sketches.SKETCHES])
    near = [(F.abs(F.col(c) - F.col(f"exact_{c}")) <= F.ceil(sketches.error() * F.col(f"exact_{c}"))).alias(f"near_{c}")
            for c in sketches.SKETCHES]
    return sketches.estimated(merged).join(counts, list(DAY), "full").select(
        *DAY, *sketches.SUMS, *[f"exact_{c}" for c in sketches.SKETCHES], *near)


@query
def features_merged(spark, folder):
    """Sketches of minutes merged to hours and these to days, beside the exact counts of days."""
    minutes = features.flat_window(sketches.sketched_features(
        features.with_window(views.event_flows(spark, folder), "60 seconds")))
    hours = sketches.merged_features(minutes.withColumn("win", F.date_trunc("hour", "win")), DAY)
    days = sketches.merged_features(hours.withColumn("win", F.date_trunc("day", "win")), DAY)
    return judged_sketches(views.event_features(spark, folder), views.plain_window(days))


@query
def stream_sketches(spark, folder):
    """Sketches of the stream's closed minutes, merged to days."""
    closed = stream_result(spark, windowed_sketches(valid_stream(views.message_stream(spark, folder))))
    merged = sketches.merged_features(closed.withColumn("win", F.date_trunc("day", "win")), DAY)
    return sketches.estimated(views.plain_window(merged)).select(*DAY, *sketches.SUMS)
