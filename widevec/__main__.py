"""``spark-submit`` entry: run the job that a configuration file describes."""

import argparse
import json
import sys
from dataclasses import asdict

from pyspark.sql import SparkSession

from widevec.config import EmbedConfig
from widevec.plans.job import run


def main(arguments=None):
    parser = argparse.ArgumentParser(prog="widevec", description=__doc__)
    parser.add_argument("config", help="JSON file naming source, texts, model and output")
    path = parser.parse_args(arguments).config
    spark = SparkSession.builder.appName("widevec").getOrCreate()
    cfg = EmbedConfig.from_json(path, spark)
    if not cfg.enable_s3_output:
        parser.error("the configuration has its output switched off, so there is nothing to run")
    print(json.dumps(asdict(run(spark, cfg).metrics)))


if __name__ == "__main__":
    sys.exit(main())
