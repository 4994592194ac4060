"""python -m strandplan.cli --input FOLDER --output FOLDER (--sro X [--sro Y] | --sros X,Y | --all-pilots | --all | --list-sros) [--until STAGE]

Exit 0: all well; 1: some area was not there; 2: bad input.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from .functions.layers import layer
from .plans.planning import STAGES, plan_areas
from .session import session
from .sources.tables import UnknownArea, one_area, write_layers

# The pilot areas.
PILOTS = (
    "63149/M06/PMZ/42478",
    "63257/QSB/PMZ/56934",
    "63210/M06/PMZ/29655",
    "63048/QBO/PMZ/56826",
    "63258/LLW/PMZ/24228",
)
INPUTS = ("bal", "za_sro", "pa", "zapa", "parcelle", "infra", "road")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strandplan", description="Plan fibre access for service areas.")
    p.add_argument("--input", required=True, help="folder of the driver's tables, or of layer tables with --layers")
    p.add_argument("--layers", action="store_true", help="the input holds the layers themselves")
    p.add_argument("--output")
    which = p.add_mutually_exclusive_group(required=True)
    which.add_argument("--sro", action="append", help="one code; may be given again")
    which.add_argument("--sros", help="codes with commas between")
    which.add_argument("--all-pilots", action="store_true", help="the five pilot areas")
    which.add_argument("--all", action="store_true", help="every area of the input")
    which.add_argument("--list-sros", action="store_true")
    p.add_argument("--until", choices=STAGES, default="layers")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = session()
    layers = {n: spark.read.parquet(f"{args.input}/{n}") if args.layers else layer(spark, args.input, n) for n in INPUTS}
    if args.list_sros:
        for r in layers["za_sro"].select("sro").dropna().distinct().orderBy("sro").toLocalIterator():
            print(r["sro"])
        return 0
    if not args.output:
        print("--output is missing", file=sys.stderr)
        return 2
    failed = 0
    if not args.all:
        given = PILOTS if args.all_pilots else args.sro or args.sros.split(",")
        wanted = [s.strip() for s in given if s.strip()]
        found = []
        for s in wanted:
            try:
                one_area(layers["za_sro"], s)
                found.append(s)
            except UnknownArea as e:
                failed += 1
                print(e, file=sys.stderr)
        layers = {n: df.where(F.col("sro").isin(found)) for n, df in layers.items()}
        if not found:
            return 1
    counts = write_layers(plan_areas(layers, args.until), args.output)
    for name, n in counts.items():
        print(f"{name}: {n}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
