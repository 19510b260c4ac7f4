"""python -m plinth.cli RECIPE --aoi NAME --config FILE: run, process (all but ingest), ingest, bridge, gold, tiles or report."""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import SparkSession

from plinth.flows import steps
from plinth.sources.config import load


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="plinth", description=__doc__)
    parser.add_argument("recipe", choices=[*steps.RECIPES, "report"])
    parser.add_argument("--aoi", help="area of interest, dashes or underscores; by default the first of the configuration")
    parser.add_argument("--config", default="config.yaml")
    given = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    settings = load(given.config)
    area = settings.area(given.aoi)
    spark = SparkSession.builder.appName(f"plinth {given.recipe} {area}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if given.recipe == "report":
        for name, df in steps.report(spark, settings, area).items():
            print(json.dumps({name: df.first().asDict()}))
        return 0
    for step in steps.RECIPES[given.recipe]:
        print(json.dumps({step.__name__: step(spark, settings, area)}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
