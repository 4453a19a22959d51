"""python -m corpuskit.cli COMMAND CONFIG.yaml [name=value ...]"""

from __future__ import annotations

import sys

import yaml
from pyspark.sql import SparkSession

from .jobs import COMMANDS, build
from .sources.manifest import load_yaml


def main(args: list[str]) -> int:
    if len(args) < 2 or args[0] not in COMMANDS:
        print(f"usage: corpuskit {{{','.join(COMMANDS)}}} CONFIG.yaml [name=value ...]", file=sys.stderr)
        return 2
    config = load_yaml(args[1]) | {k: yaml.safe_load(v) for k, _, v in (a.partition("=") for a in args[2:])}
    job = build(args[0], config)
    spark = SparkSession.builder.appName(f"corpuskit {args[0]}").getOrCreate()
    print(yaml.safe_dump(job.run(spark), sort_keys=False, allow_unicode=True))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
