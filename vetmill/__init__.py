"""vetmill: Spark jobs for moving and mirroring veterinary-practice records."""

from __future__ import annotations

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def share_path(spark) -> None:
    """Let Python workers find this package where it is run from a checkout that they can see;
    a cluster whose workers cannot has it installed."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
