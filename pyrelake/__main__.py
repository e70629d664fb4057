"""python -m pyrelake SETTINGS.toml ingest WORLD FOLDER | arrange WORLD | mask CLASSES REGIONS | thresholds | monthly WORLD [YEARS] | pack WORLD | export FOLDER | verify LISTING.json FOLDER.

Exit 1: refused; 2: no input; 3: a file is not what its listing says.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.errors import AnalysisException

from .config import WORLDS, load
from .functions.names import parse_years
from .operators import listing, packing
from .operators.calendar import Refused
from .plans import run
from .session import session
from .sources.layout import Layout, stored_text, years_stored


def main(argv: list[str] | None = None, spark=None) -> int:
    p = argparse.ArgumentParser(prog="pyrelake", description=__doc__)
    p.add_argument("settings")
    p.add_argument("--allow-missing", action="store_true", help="go on without some years")
    p.add_argument("--allow-short-tail", action="store_true", help="take years that end early")
    sub = p.add_subparsers(dest="command", required=True)
    ingest, mask = sub.add_parser("ingest"), sub.add_parser("mask")
    ingest.add_argument("world", choices=WORLDS)
    ingest.add_argument("folder")
    ingest.add_argument("--names", help="pattern of file names of another source")
    mask.add_argument("classes", help="FILE:VARIABLE of vegetation classes")
    mask.add_argument("regions", help="FILE:VARIABLE of regions, named by attributes class_1 and so on")
    arrange = sub.add_parser("arrange", help="lay stored days out by cell as well")
    arrange.add_argument("world", choices=WORLDS)
    arrange.add_argument("--buckets", type=int)
    thresholds = sub.add_parser("thresholds")
    thresholds.add_argument("years", nargs="?", help="the reference period if left out; they name the stored thresholds too")
    monthly = sub.add_parser("monthly")
    pack = sub.add_parser("pack")
    for s in (monthly, pack):
        s.add_argument("world", choices=WORLDS)
    monthly.add_argument("years", nargs="?", help="all that are stored if left out")
    monthly.add_argument("--regions", default="1-14", help="region ids, as 1-14 or 1,2,5")
    monthly.add_argument("--thresholds", help="years FIRST-LAST of stored thresholds; the reference period's, or else the latest, if left out")
    pack.add_argument("--force", action="store_true")
    pack.add_argument("--chunk-years", type=int, default=10, help="years of a blob")
    pack.add_argument("--quality", type=int, default=packing.QUALITY, help="of compression, 0 to 11")
    export = sub.add_parser("export", help="write packed worlds as files in a client's form")
    export.add_argument("folder")
    export.add_argument("--worlds", nargs="*", choices=WORLDS, help="all that are packed if left out")
    verify = sub.add_parser("verify")
    verify.add_argument("listing")
    verify.add_argument("folder")
    args = p.parse_args(argv)
    try:
        settings = load(args.settings)
        layout, spark = Layout(settings.root), spark or session()
        if args.command == "ingest":
            print("years:", *run.ingest(spark, layout, args.world, args.folder, args.names))
        elif args.command == "arrange":
            print("buckets:", run.arrange(spark, layout, args.world, args.buckets))
        elif args.command == "mask":
            run.make_masks_of_files(spark, layout, settings, *[tuple(x.rsplit(":", 1)) for x in (args.classes, args.regions)])
        elif args.command == "thresholds":
            if args.years:
                settings = settings.of_years(parse_years(args.years))
            run.make_thresholds(spark, layout, settings, args.allow_missing, args.allow_short_tail).show(truncate=False)
        elif args.command == "monthly":
            ids = sorted({k for part in args.regions.split(",") for a, _, b in [part.partition("-")] for k in range(int(a), int(b or a) + 1)})
            run.make_monthly(spark, layout, settings, args.world, list(parse_years(args.years)) if args.years else years_stored(spark, layout.daily, args.world), ids, args.allow_short_tail, args.allow_missing, args.thresholds).show()
        elif args.command == "export":
            packed = list(json.loads(stored_text(spark, layout.manifest) or '{"worlds": {}}')["worlds"])
            print(*sorted(run.export(spark, layout, settings, args.worlds or packed, args.folder)["worlds"]))
        elif args.command == "verify":
            pages = spark.read.text(args.listing, wholetext=True).withColumnRenamed("value", "json")
            found = listing.status(listing.entries(pages, ""), listing.digests(spark, args.folder))
            counts = {r.status: r["count"] for r in found.groupBy("status").count().collect()}
            print(", ".join(f"{k}: {n}" for k, n in sorted(counts.items())))
            if set(counts) <= {"missing"}:
                raise run.NoInput("none of the files is there")
            return 3 if counts.get("corrupt") else 0
        else:
            named = json.loads(stored_text(spark, layout.region_names) or "{}")
            print(run.make_bundle(spark, layout, settings, args.world, {int(k): v for k, v in named.items()}, force=args.force, years_each=args.chunk_years, quality=args.quality))
    except run.NoInput as e:
        print(e, file=sys.stderr)
        return 2
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        print(e.getMessage(), file=sys.stderr)
        return 2
    except (Refused, ValueError) as e:
        print(f"refused: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
