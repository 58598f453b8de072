"""The command line: worklist, enrich, enrich-ids, escalation, assemble, finalize, score, publish.

Exit codes: 0 done, 1 a step failed or an argument is missing, 2 no such command, 3 a score missed its gate.
"""

from __future__ import annotations

import json
import sys

from titlewright.operators.classify import ClassifierConfig
from titlewright.plans import build

USAGE = "usage: python -m titlewright.cli worklist|enrich|enrich-ids|escalation|assemble|finalize|score|publish [--name value | --flag]..."


class Args:
    """--name value, or --flag where no value follows. The last of equal names wins; other words are passed over."""

    def __init__(self, argv: list[str]):
        self.values: dict[str, str] = {}
        self.flags: set[str] = set()
        i = 0
        while i < len(argv):
            name = argv[i]
            i += 1
            if not name.startswith("--"):
                continue
            if i < len(argv) and not argv[i].startswith("--"):
                self.values[name] = argv[i]
                i += 1
            else:
                self.flags.add(name)

    def get(self, name: str, default=None, kind=str):
        try:
            return kind(self.values[name])
        except (KeyError, ValueError):
            return default

    def need(self, name: str, kind=str):
        got = self.get(name, None, kind)
        if got is None:
            raise build.StepError(f"missing {name}")
        return got

    def has(self, name: str) -> bool:
        return name in self.flags or name in self.values


def _media(args: Args) -> str:
    return "tv" if args.get("--media") == "tv" else "movie"


def _worklist(spark, args: Args) -> int:
    export = args.get("--mode") == "export"
    source = args.need("--file" if export else "--catalogue")
    origins = tuple(x for x in args.get("--origins", "").split(",") if x)
    years = args.get("--year-min", 1920, int), args.get("--year-max", 2026, int)
    out = args.need("--out")
    n = build.worklist(spark, source, out, "export" if export else "discover", _media(args), args.get("--count", 500, int), args.get("--vote-floor", 50, int), origins, years)
    print(f"worklist: {n} {_media(args)} ids -> {out}")
    return 0


def _enrich(spark, args: Args) -> int:
    print(json.dumps(build.enrich_batch(spark, args.need("--worklist"), args.need("--catalogue"), args.need("--out-dir"), args.get("--vote-floor", 50, int), args.get("--limit", 150, int))))
    return 0


def _enrich_ids(spark, args: Args) -> int:
    print(json.dumps(build.enrich_ids(spark, args.need("--ids"), args.need("--catalogue"), args.need("--out-dir"), args.need("--batch-id", int), _media(args))))
    return 0


def _escalation(spark, args: Args) -> int:
    print(json.dumps(build.escalation(spark, args.need("--out-dir"), args.need("--batch-id", int))))
    return 0


def _assemble(spark, args: Args) -> int:
    base = ClassifierConfig()
    cfg = ClassifierConfig(args.get("--sub-threshold", base.subgenre, float), args.get("--thematic-threshold", base.thematic, float), args.get("--mood-threshold", base.mood, float))
    print(json.dumps(build.assemble(spark, args.need("--out-dir"), args.need("--batch-id", int), args.has("--force"), cfg)))
    return 0


def _finalize(spark, args: Args) -> int:
    meta = build.finalize(spark, args.need("--out-dir"))
    print(f"finalize: {meta['count']} titles, dataset {meta['datasetVersion']}")
    return 0


def _score(spark, args: Args) -> int:
    s = build.score_labels(spark, args.need("--labels"), args.need("--golden"))
    print(f"golden score: {s['covered']} of {s['total']} covered")
    print(f"primary genre accuracy {s['accuracy']:.3f}, micro F1 {s['micro']:.3f}, macro F1 {s['macro']:.3f}")
    for name in ("subgenres", "thematic", "moods"):
        f = s["families"].get(name)
        print(f"{name}: no predictions (n/a)" if f is None else f"{name}: precision {f['precision']:.3f}, recall {f['recall']:.3f}, F1 {f['f1']:.3f} (tp={f['tp']} fp={f['fp']} fn={f['fn']}), target {f['target']:.2f}{', missed' if f['miss'] else ''}")
    if args.has("--gate") and s["failed"]:
        print("gate failed: a family missed its target", file=sys.stderr)
        return 3
    return 0


def _publish(spark, args: Args) -> int:
    for name, size in build.publish(spark, args.need("--out-dir"), args.need("--to")).items():
        print(f"published {name}: {size} bytes")
    return 0


COMMANDS = {"worklist": _worklist, "enrich": _enrich, "enrich-ids": _enrich_ids, "escalation": _escalation, "assemble": _assemble, "finalize": _finalize, "score": _score, "publish": _publish}


def main(argv: list[str], spark=None) -> int:
    if not argv or argv[0] not in COMMANDS:
        print(USAGE, file=sys.stderr)
        return 2
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        return COMMANDS[argv[0]](spark, Args(argv[1:]))
    except (build.StepError, ValueError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
