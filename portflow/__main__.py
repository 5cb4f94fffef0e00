"""The whole job as a command: raw message files to Gold tables.

    python -m portflow LAKE RAW [--zip] [--source NAME] [--ports FILE] [--as-of TIME] [--flag-all] [--retire]
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from datetime import datetime

from portflow.operators.duplicates import FLAG_ALL, KEEP_FIRST
from portflow.operators.places import port_table
from portflow.plans.pipeline import Pipeline
from portflow.session import build_session
from portflow.settings import Settings
from portflow.sources.ports import DEFAULT_PORTS, read_ports
from portflow.sources.raw import read_raw_csv, read_raw_zip


def main(arguments: Sequence[str] | None = None) -> dict[str, dict[str, int]]:
    """Run the job; prints and returns the row counts of every table it has written."""
    parser = argparse.ArgumentParser(prog="portflow", description="Raw vessel messages to daily port congestion.")
    parser.add_argument("lake", help="folder of the lake's tables")
    parser.add_argument("raw", help="folder or pattern of the message files")
    parser.add_argument("--zip", action="store_true", help="the files are zip archives of CSV files")
    parser.add_argument("--source", help="name of the delivery, whose rows a rerun replaces; the raw path by default")
    parser.add_argument("--ports", help="CSV file of ports; five known ones by default")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="processing time in UTC; now by default")
    parser.add_argument("--flag-all", action="store_true", help="reject every copy of a repeated message")
    parser.add_argument("--retire", action="store_true", help="remove the folders of earlier runs afterwards")
    chosen = parser.parse_args(arguments)

    spark = build_session()
    reader = read_raw_zip if chosen.zip else read_raw_csv
    raw = reader(spark, chosen.raw, quarantine=True)
    settings = Settings(as_of=chosen.as_of) if chosen.as_of else Settings()
    ports = port_table(read_ports(spark, chosen.ports)) if chosen.ports else DEFAULT_PORTS
    policy = FLAG_ALL if chosen.flag_all else KEEP_FIRST
    pipeline = Pipeline(spark, chosen.lake, settings, ports, policy)
    counts = pipeline.run(raw, chosen.source or chosen.raw)
    if chosen.retire:
        pipeline.retire()
    print(json.dumps(counts))
    return counts


if __name__ == "__main__":
    main()
