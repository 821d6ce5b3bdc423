"""Command line: python -m hexloom.plans.cli --source DIR --out DIR [--release R] [--themes a,b] [--files N] [--anonymous BUCKET@REGION] [--dry-run]"""

from __future__ import annotations

import argparse
import logging
import os
import sys

from hexloom.sources import releases

THEMES = ("places", "transportation", "base", "buildings", "addresses")
OTHERS = ("addresses_v2",)  # built only if named


def main(argv: list[str] | None = None, spark=None, get=releases.fetch) -> int:
    p = argparse.ArgumentParser(prog="hexloom")
    p.add_argument("--source", required=True, help="folder of the release's theme= folders; {release} is filled in")
    p.add_argument("--out", required=True)
    p.add_argument("--release", default=os.environ.get("HEXLOOM_RELEASE"))
    p.add_argument("--catalog", help="JSON catalog to read the latest release from")
    p.add_argument("--themes", default=",".join(THEMES))
    p.add_argument("--state", default="state/last-release.txt")
    p.add_argument("--files", type=int, help="files of each level and country; else one where small, ranges where large")
    p.add_argument("--anonymous", metavar="BUCKET[@REGION]", help="read this public bucket without credentials")
    p.add_argument("--dry-run", action="store_true")
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    names = [t for t in a.themes.split(",") if t]
    if unknown := set(names) - {*THEMES, *OTHERS}:
        p.error(f"unknown themes: {', '.join(sorted(unknown))}")
    release = a.release or (releases.latest(a.catalog, get) if a.catalog else None)
    if not release:
        p.error("give --release or --catalog")
    print(f"release {release}, themes {', '.join(names)}")
    if a.dry_run:
        return 0
    from hexloom import session
    from hexloom.plans import build
    from hexloom.sources import features

    spark = spark or session.build()
    if a.anonymous:
        bucket, _, region = a.anonymous.partition("@")
        features.anonymous_store(spark, bucket, region or None)
    try:
        build.writable(spark, a.out)
    except Exception:
        logging.exception("nothing can be written to %s", a.out)
        return 1
    failed = build.build(spark, names, a.source.replace("{release}", release), a.out, release, a.files)
    if failed:
        print(f"failed: {', '.join(failed)}", file=sys.stderr)
        return 1
    releases.remember(a.state, release)  # only a whole build is remembered
    return 0


if __name__ == "__main__":
    sys.exit(main())
