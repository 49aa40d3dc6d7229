"""Command line: the phases of the reference as Spark jobs over table paths.

    python -m dockflow features --readings R --out F           # C5 + K1 + K2
    python -m dockflow explore  --readings R --out E           # A8-A20 tables
    python -m dockflow tune     --features F --out T --model ridge --trials 50   # M9 + M10
    python -m dockflow train    --features F --out M [--params T/best]           # M11, M12, M14, K5
    python -m dockflow predict  --features F --model M/best_model --out P        # M13 + K4
    python -m dockflow report   --predictions P --results M/results [--importance M/importance] --out K  # K6
    python -m dockflow ingest   --status S --info I --weather W --target H --checkpoint C  # ST1-ST3

Paths may be local, HDFS or object-store URIs. ``--master`` defaults to the
launcher's setting; a local master gets a scratch checkpoint folder only when
``spark.checkpoint.dir`` is unset.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _session(args) -> SparkSession:
    from .session import build_session, cluster_session
    if args.master:
        return build_session(args.master, args.shuffle_partitions)
    return cluster_session("dockflow")


def _read(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "csv":
        from .sources.files import scan_readings
        return scan_readings(spark, path, "csv")
    return spark.read.format(fmt).load(path)


def cmd_features(spark, args) -> dict:
    from .plans.features import feature_table
    from .sinks import writers as W
    raw = _read(spark, args.readings, args.format)
    ft, prof, cutoff = feature_table(raw, q=args.train_quantile)
    W.export_feature_tables(ft, f"{args.out}/features")
    W.export_station_dim(raw, f"{args.out}/stations")
    return {"cutoff_us": cutoff, "global_mean": prof.global_mean, "lookup_sizes": prof.sizes}


def cmd_explore(spark, args) -> dict:
    from .operators import explore as X
    from .operators.clean import cleaning_audit
    from .plans.exploration import viz_prepared
    from .schema import TARGET_RAW
    raw = _read(spark, args.readings, args.format)
    viz = viz_prepared(raw)
    tables = {
        "cleaning_audit": cleaning_audit(raw),
        "coverage": X.coverage_summary(raw),
        "readings_per_day": X.readings_per_day(raw),
        "readings_per_weekday": X.readings_per_weekday(raw),
        "fill_mean_median": X.fill_mean_median(viz),
        "fill_histogram": X.equiwidth_histogram(viz, TARGET_RAW, 50),
        "boxplot_top20": X.boxplot_by_station(viz, X.top_stations_by_count(viz, 20)),
        "profile_by_hour": X.profile_by_hour(viz),
        "profile_by_weekday": X.profile_by_weekday(viz),
        "weather_impact": X.weather_impact(viz),
        "vacation_impact": X.vacation_impact(viz),
        "station_ratio": X.morning_evening_ratio(viz, digits=None),
        "fill_bands": X.fill_band_counts(viz),
    }
    tables["profile_counts"] = X.profile_counts(tables["station_ratio"])
    tables["mean_fill_by_station"] = X.mean_fill_by_station(viz)
    tables["station_map"] = X.station_map_table(viz, tables["station_ratio"])
    anomaly = monthly_anomaly_transform(viz)
    tables["temp_anomaly_histogram"] = X.equiwidth_histogram(anomaly, "temp_anom", 60)
    tables["ratio_histogram"] = X.equiwidth_histogram(tables["station_ratio"].where("ratio IS NOT NULL"), "ratio", 40)
    tables["temp_anomaly_sample"] = X.seeded_sample(
        anomaly.withColumn("_id", F.concat_ws("|", "station_id", "datetime")), 8000, 42, "_id").drop("_id")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{args.out}/{name}")
    return {"tables": sorted(tables)}


def _features_split(spark, path):
    from .schema import FEATURES, TARGET
    from .sinks.writers import load_checked
    ft = load_checked(spark, path, required=FEATURES + [TARGET, "split"])
    return ft.where(F.col("split") == "train"), ft.where(F.col("split") == "test")


def cmd_tune(spark, args) -> dict:
    from .ml import models as M
    from .schema import FEATURES_SEARCH
    train, _ = _features_split(spark, f"{args.features}")
    trials_path = f"{args.out}/trials"
    from .session import path_exists
    done = []
    if path_exists(spark, trials_path):     # a crash or a smaller search: go on with the missing trials
        stored = M.read_trials(spark, trials_path).where(F.col("model") == args.model)
        done = [r["trial"] for r in stored.select("trial").collect()]

    def keep(row) -> None:
        i = row.first()["trial"]
        row.coalesce(1).write.mode("overwrite").parquet(f"{trials_path}/{args.model}-{i:05d}")
    M.param_search(args.model, train, FEATURES_SEARCH, args.trials, seed=args.seed,
                   parallelism=args.parallelism, done=done, on_trial=keep)
    best = M.best_trial_per_model(M.read_trials(spark, trials_path))
    best.write.mode("overwrite").parquet(f"{args.out}/best")
    return {"best": [r.asDict(recursive=True) for r in best.collect()]}


def cmd_train(spark, args) -> dict:
    from .ml import models as M
    from .schema import FEATURES
    from .sinks import writers as W
    train, test = _features_split(spark, args.features)
    tuned = {}
    if args.params:
        for r in spark.read.parquet(args.params).collect():
            tuned[r["model"]] = {k: float(v) for k, v in r["params"].items()}
    kinds = [k for k in args.models.split(",") if k]
    fitted = [M.fit(k, train, FEATURES, tuned.get(k)) for k in kinds]
    board = M.train_and_rank(fitted, test)
    best_name = board.where(F.col("rank") == 1).first()["Modele"]
    best = next(f for f in fitted if f.name == best_name)
    M.save_model(best.model, f"{args.out}/best_model")
    imp = M.feature_importance(best.model, FEATURES)
    W.export_results(board, imp, args.out)
    return {"best": best_name, "models": {f.name: f.info for f in fitted}}


def cmd_predict(spark, args) -> dict:
    from .ml import models as M
    from .operators import evaluate as E
    from .schema import TARGET, TARGET_RAW
    from .sinks import writers as W
    _, test = _features_split(spark, args.features)
    model = M.load_model(args.model)
    raw = E.reconstruct(M.predict(model, test))          # metrics of the unrounded predictions
    res = E.regression_metrics(raw, TARGET, "residual_pred").first().asDict()
    rec = E.regression_metrics(raw, TARGET_RAW, "taux_pred").first().asDict()
    W.export_predictions(M.score_and_reconstruct(model, test), args.out)
    return {"residual": res, "reconstructed": rec}


def cmd_report(spark, args) -> dict:
    from .operators import evaluate as E
    from .schema import TARGET_RAW
    preds = spark.read.parquet(args.predictions)
    results = spark.read.parquet(args.results)
    board = results if "rank" in results.columns else E.leaderboard(results)
    parts = [
        board.select(F.lit("benchmark").alias("section"), F.col("rank").alias("ord"),
                     F.col("Modele").alias("label"), F.col("MAE").alias("value")),
        E.error_histogram(preds).select(F.lit("error_histogram").alias("section"),
                                        F.col("bin").alias("ord"), "label", F.col("share").alias("value")),
    ]
    met = E.regression_metrics(preds, TARGET_RAW, "taux_pred").first()
    gain = E.gain_vs_mean_baseline(preds).first()
    p90 = E.abs_error_percentile(preds).first()["p90"]
    parts.append(spark.createDataFrame(
        [("fill_rate", 1, "MAE", met["MAE"]), ("fill_rate", 2, "R2", met["R2"]),
         ("fill_rate", 3, "P90", p90), ("fill_rate", 4, "gain_pct", gain["gain_pct"])],
        "section string, ord int, label string, value double"))
    from .sinks.writers import load_checked
    imp = load_checked(spark, args.importance, ["feature", "importance"], optional=True) \
        if args.importance else None          # a baseline winner has no importances
    if imp is not None:
        top = E.top_features(imp)
        parts.append(top.select(F.lit("features").alias("section"), F.lit(0).alias("ord"),
                                F.col("feature").alias("label"), F.col("importance").alias("value")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    out.coalesce(1).write.mode("overwrite").parquet(args.out)
    return {"rows": out.count()}


def cmd_ingest(spark, args) -> dict:
    from .streaming import ingest as ST
    from .streaming.context import ContextTables
    context = ContextTables(f"{args.checkpoint}/context")
    vac = spark.read.parquet(args.vacation) if args.vacation else None
    hol = spark.read.parquet(args.holidays) if args.holidays else None
    stream = ST.snapshot_stream(spark, args.status, info_dir=args.info, weather_dir=args.weather)
    q = ST.append_sink(stream, args.target, f"{args.checkpoint}/metrics", f"{args.checkpoint}/stream",
                       context=context if args.info or args.weather else None,
                       transform=ST.snapshot_enrichment(context.info, context.weather, vac, hol),
                       max_records_per_file=args.max_records_per_file, available_now=args.once,
                       processing_time=args.every)
    q.awaitTermination()
    return {"target": args.target}


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="dockflow")
    ap.add_argument("--master", default=None)
    ap.add_argument("--shuffle-partitions", type=int, default=8)
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("features")
    p.add_argument("--readings", required=True)
    p.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    p.add_argument("--train-quantile", type=float, default=0.80)
    p.add_argument("--out", required=True)
    p = sub.add_parser("explore")
    p.add_argument("--readings", required=True)
    p.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    p.add_argument("--out", required=True)
    p = sub.add_parser("tune")
    p.add_argument("--features", required=True)
    p.add_argument("--model", default="ridge", choices=["ridge", "rf", "gbt", "gbt_es"])
    p.add_argument("--trials", type=int, default=50)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--parallelism", type=int, default=2)
    p.add_argument("--out", required=True)
    p = sub.add_parser("train")
    p.add_argument("--features", required=True)
    p.add_argument("--models", default="baseline,ridge,rf,gbt_es")
    p.add_argument("--params", default=None, help="best-trial table written by 'tune'")
    p.add_argument("--out", required=True)
    p = sub.add_parser("predict")
    p.add_argument("--features", required=True)
    p.add_argument("--model", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("report")
    p.add_argument("--predictions", required=True)
    p.add_argument("--results", required=True)
    p.add_argument("--importance", default=None)
    p.add_argument("--out", required=True)
    p = sub.add_parser("ingest")
    p.add_argument("--status", required=True)
    p.add_argument("--info", default=None)
    p.add_argument("--weather", default=None)
    p.add_argument("--vacation", default=None)
    p.add_argument("--holidays", default=None)
    p.add_argument("--target", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--max-records-per-file", type=int, default=5_000_000)
    p.add_argument("--once", action="store_true", help="drain what has landed and stop")
    p.add_argument("--every", default="5 minutes")
    args = ap.parse_args(argv)
    spark = _session(args)
    from .plans.catalog import prepare
    prepare(spark)
    handlers = {"features": cmd_features, "explore": cmd_explore, "tune": cmd_tune, "train": cmd_train,
                "predict": cmd_predict, "report": cmd_report, "ingest": cmd_ingest}
    out = handlers[args.cmd](spark, args)
    from .session import release_tables
    release_tables(spark)          # outputs are written; intermediates can go
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
