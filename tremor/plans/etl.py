"""The batch job end to end: land, clean, store, summarise, train, score, store.

``run_etl`` is the whole pipeline as one function over a raw catalogue and a
holdout feed.  The raw (string) landing data is parsed exactly once, into a
typed table of every row; everything else is read from that columnar copy.
Outputs go to a folder (parquet by default, the format is a parameter): the
typed rows, the curated catalogue partitioned by Year, yearly statistics,
predictions and the fitted model.  The curated table is read back from the
store before training, so the model trains on exactly what was stored, and the
stored copy also cuts the lineage between the cleaning and the training jobs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tremor import schema
from tremor.operators import clean as C
from tremor.operators import ml, stats
from tremor.sources import catalog as src
from tremor.sources import sinks


@dataclass
class EtlResult:
    """The folders of the versions this run wrote; ``read_catalog`` and ``load_model`` on the folder above find the current one."""

    catalog_path: str
    yearly_path: str
    predictions_path: str
    model_path: str
    rmse: float


def run_etl(
    spark: SparkSession,
    raw: DataFrame,
    feed: DataFrame,
    out_dir: str,
    fmt: str = "parquet",
    model_name: str = "RandomForest",
    prediction_year: int = ml.PREDICTION_YEAR,
) -> EtlResult:
    out = out_dir.rstrip("/")
    paths = {k: f"{out}/{k}" for k in ("typed", "quakes", "quake_freq", "pred_results", "model")}

    # The landing data is parsed once: every row, typed and flagged, goes to a
    # columnar table (written as it comes, one file per task, no shuffle);
    # the curated catalogue and the yearly statistics (which count rows the
    # cleaning drops) are both read from it.  Only the curated catalogue pays
    # for the Year layout.
    # Each output is a new version of its table: a job that dies leaves the old ones readable.
    typed_rows = src.read_catalog(spark, sinks.replace_table(C.typed_flagged(raw), paths["typed"], fmt), fmt)
    quakes = sinks.replace_catalog(typed_rows.where("complete").drop("complete"), paths["quakes"], fmt)
    yearly = sinks.replace_table(stats.yearly_stats_typed(typed_rows.select("Year", "Magnitude")), paths["quake_freq"], fmt)

    stored = src.read_catalog(spark, quakes, fmt)
    train = ml.model_frame(stored)
    test = ml.model_frame(C.harmonize_feed(feed))
    model = ml.fit(train, model_name)
    saved = sinks.replace_model(model, paths["model"])

    err = ml.rmse(model, test)
    predicted = sinks.replace_table(ml.prediction_table(model, test, prediction_year, err), paths["pred_results"], fmt)
    return EtlResult(quakes, yearly, predicted, saved, err)


def run_etl_csv(spark: SparkSession, catalog_csv: str, feed_csv: str, out_dir: str, **kw) -> EtlResult:
    """Same job from CSV files (string landing schema, header row)."""
    raw = src.read_raw_csv(spark, catalog_csv)
    feed = src.read_raw_csv(spark, feed_csv)
    C.require_columns(raw, ["Date", *schema.NUMERIC_COLUMNS, "Type", "ID"])
    return run_etl(spark, raw, feed, out_dir, **kw)


def main(argv=None) -> int:
    """``python -m tremor.plans.etl CATALOG_CSV FEED_CSV OUT_DIR [--model NAME] [--format FMT]``"""
    import argparse

    from tremor.session import build_session

    ap = argparse.ArgumentParser(prog="tremor.plans.etl", description="clean, store, summarise, train, score")
    ap.add_argument("catalog_csv")
    ap.add_argument("feed_csv")
    ap.add_argument("out_dir")
    ap.add_argument("--model", default="RandomForest", choices=list(ml.MODEL_NAMES))
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--year", type=int, default=ml.PREDICTION_YEAR)
    args = ap.parse_args(argv)
    spark = build_session()
    res = run_etl_csv(
        spark, args.catalog_csv, args.feed_csv, args.out_dir, fmt=args.format, model_name=args.model,
        prediction_year=args.year,
    )
    print(f"catalogue {res.catalog_path}\nyearly {res.yearly_path}\npredictions {res.predictions_path}")
    print(f"model {res.model_path}\nRMSE on the feed = {res.rmse:g}")
    return 0


if __name__ == "__main__":
    import sys

    sys.exit(main())
