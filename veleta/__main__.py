"""Command line: ``python -m veleta <stage> <paths…>``."""

from __future__ import annotations

import argparse

from veleta.operators import langmodel
from veleta.plans import gold, graph, incremental, ingest, prep, silver
from veleta.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="veleta")
    stages = parser.add_subparsers(dest="stage", required=True)

    def stage(name: str, *paths: str, **options):
        p = stages.add_parser(name)
        for path in paths:
            p.add_argument(path)
        for option, default in options.items():
            p.add_argument(f"--{option}", type=type(default), default=default)

    stage("live", "landing", "bronze", "quarantine", "checkpoints", seconds=60)
    stage("archive", "folder", "out", languages="")
    stage("silver", "bronze", "out")
    stage("silver-update", "bronze", "out")
    stage("language-model", "texts", "model", text="text", lang="lang")
    stage("features", "silver", "out_a", "out_b", concepts="")
    stage("predict-a", "features", "model", "out", labels="")
    stage("predict-b", "features", "model", "out", labels="")
    stage("compare", "pred_a", "pred_b", "report")
    stage("triples", "silver", "out", ntriples="")
    stage("semantic", "triples", "out")
    stage("questions", "triples", "folder")
    stage("quality", "triples", "report")
    stage("sentiment", "silver", "stars", "folder")
    stage("train", "folder", "model")
    stage("score", "silver", "model", "out")
    stage("evaluate", "folder", "model", "report")
    stage("silver-report", "silver", "report")
    a = parser.parse_args(argv)
    spark = build_session(f"veleta-{a.stage}")
    table = lambda path: spark.read.parquet(path) if path else None
    {
        "live": lambda: ingest.run_live(spark, a.landing, a.bronze, a.quarantine, a.checkpoints,
                                        a.seconds),
        "archive": lambda: ingest.run_archive(spark, a.folder, a.out, model=a.languages),
        "silver": lambda: silver.run(spark, a.bronze, a.out),
        "silver-update": lambda: print(len(incremental.update(spark, a.bronze, a.out)), "buckets rewritten"),
        "language-model": lambda: langmodel.fit(table(a.texts), a.text, a.lang).save(spark, a.model),
        "features": lambda: gold.run_features(spark, a.silver, [c for c in a.concepts.split(",") if c],
                                              a.out_a, a.out_b),
        "predict-a": lambda: gold.run_predict_a(spark, a.features, a.model, a.out, table(a.labels)),
        "predict-b": lambda: gold.run_predict_b(spark, a.features, a.model, a.out, table(a.labels)),
        "compare": lambda: gold.run_compare(spark, a.pred_a, a.pred_b, a.report),
        "triples": lambda: graph.run_generate(spark, a.silver, a.out, a.ntriples or None),
        "semantic": lambda: graph.run_semantic_features(spark, a.triples, a.out),
        "questions": lambda: graph.run_questions(spark, a.triples, a.folder),
        "quality": lambda: graph.run_quality(spark, a.triples, a.report),
        "sentiment": lambda: prep.run(spark, a.silver, table(a.stars), a.folder),
        "train": lambda: print(prep.run_train(spark, a.folder, a.model)),
        "score": lambda: prep.run_score(spark, a.silver, a.model, a.out),
        "evaluate": lambda: prep.run_evaluate(spark, a.folder, a.model, a.report),
        "silver-report": lambda: silver.run_report(spark, a.silver, a.report),
    }[a.stage]()


if __name__ == "__main__":
    main()
