"""Pangenome allele analytics on Spark DataFrames."""

import os


def reachable(spark) -> None:
    """Lets Python workers that share this file system find the package, whatever the working folder; elsewhere it is shipped
    with --py-files."""
    root, env = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), spark.sparkContext.environment
    known = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])
