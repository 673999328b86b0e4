"""``python -m plinth [settings.yaml]``: one run as the settings say; paths are relative to the settings' folder."""

import sys
from pathlib import Path

from pyspark.sql import SparkSession

from plinth.plans.run import NO_INPUT, run
from plinth.sources.settings import load_settings


def main(arguments: list[str]) -> int:
    path = Path(arguments[0] if arguments else "settings.yaml")
    if not path.exists():
        print(f"Settings not found: {path}")
        return NO_INPUT
    spark = SparkSession.builder.appName("plinth").getOrCreate()
    try:
        return run(spark, load_settings(path), path.resolve().parent)
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
