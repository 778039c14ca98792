"""Batch job: ``spark-submit --py-files ... kelpline/job.py SETTINGS.json``.

The settings name an action and its inputs::

    {"action": "publish", "environment": "PROD", "packages": ["/shared/incoming"], "work": "/shared/work",
     "codes": "/shared/codes.txt", "areas": "/shared/areas.txt", "rules": "/shared/rules.txt",
     "policy": {"restrict": true}, "reports": "/shared/reports",
     "targets": {"PROD": {"datasets": "/shared/prod", "store": "/shared/prod_zip"},
                 "UTVTST": {"datasets": "/shared/test", "store": "/shared/test_zip"}}}

    {"action": "copy", "environment": "PROD", "packages": [...], "allow_all": false, "policy": {...}, "targets": {...}}

    {"action": "remove", "environment": "PROD", "names": "/shared/names.txt", "targets": {...}}
"""

from __future__ import annotations

import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.operators import report
from kelpline.plans.archives import Target, copy_to_environment, publish_to_environment, remove_from_stores, write_removals
from kelpline.policy import Policy
from kelpline.session import builder, ship_package
from kelpline.sources.tables import read_areas, read_codes, read_name_list, read_rules


def run(spark: SparkSession, settings: dict) -> None:
    ship_package(spark)
    targets = {name: Target(**t) for name, t in settings["targets"].items()}
    environment = settings["environment"]
    policy = Policy(**{k: tuple(v) if isinstance(v, list) else v for k, v in settings.get("policy", {}).items()})
    if settings["action"] == "publish":
        rules = read_rules(spark, settings["rules"]) if "rules" in settings else None
        results = publish_to_environment(
            spark,
            settings["packages"],
            environment,
            targets,
            settings["work"],
            read_codes(spark, settings["codes"]),
            read_areas(spark, settings["areas"]),
            policy,
            rules=rules,
            prune=settings.get("prune", False),
            allow_all=settings.get("allow_all", False),
        )
        _report(results, settings)
    elif settings["action"] == "copy":
        allow_all = settings.get("allow_all", False)
        _report(copy_to_environment(spark, settings["packages"], environment, targets, policy, allow_all), settings)
    elif settings["action"] == "remove":
        names = read_name_list(spark, settings["names"])
        if names is None:
            raise FileNotFoundError(settings["names"])
        write_removals(spark, names, environment, targets)
        log = remove_from_stores(spark, names, environment, targets)
        if "reports" in settings:
            report.write_reports(log, f"{settings['reports']}/removal")
    else:
        raise ValueError(settings["action"])


def _report(results: dict, settings: dict) -> None:
    if "reports" in settings:
        for name, done in results.items():
            report.write_reports(done.log, f"{settings['reports']}/{name}")
            for kind in ("refused", "failed"):
                frame: DataFrame = getattr(done, kind)
                frame.select(F.col("msg").alias("value")).write.text(f"{settings['reports']}/{name}_{kind}")


def main() -> None:
    with open(sys.argv[1], encoding="utf-8") as file:
        settings = json.load(file)
    run(builder("kelpline").getOrCreate(), settings)


if __name__ == "__main__":
    main()
