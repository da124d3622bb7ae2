"""Reports of a corpus build and of an import, as text, from their statistics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from lettermill.config import SPLITS

#: What a build drops, by the name of its counter.
DROPS = {
    "dropped_non_email": "no mail",
    "dropped_non_english": "not English",
    "dropped_empty_or_undetected": "empty or of unknown language",
    "dropped_duplicate": "equal to an earlier text",
    "dropped_near_thinned": "thinned from large clusters",
}


def _rows(pairs: Iterable[tuple[str, object]], width: int = 28) -> list[str]:
    return [f"  {name:{width}s} {value}" for name, value in pairs]


def _table(cells: Mapping[str, int]) -> list[str]:
    """Counts by `source|label|split` as rows by source and label, columns by split, with sums of both."""
    by_row: dict[tuple[str, str], dict[str, int]] = {}
    for key, n in cells.items():
        source, label, part = key.split("|")
        by_row.setdefault((source, label), {})[part] = n
    line = lambda names, counts: f"  {names[0]:14s} {names[1]:12s}" + "".join(f" {c:>9}" for c in counts)
    out = [line(("source", "label"), [*SPLITS, "total"])]
    sums = dict.fromkeys(SPLITS, 0)
    for names, own in sorted(by_row.items()):
        counts = [own.get(s, 0) for s in SPLITS]
        sums = {s: sums[s] + n for s, n in zip(SPLITS, counts, strict=True)}
        out.append(line(names, [*counts, sum(counts)]))
    return [*out, line(("total", ""), [*sums.values(), sum(sums.values())])]


def build_report(stats: Mapping, out: str | None = None) -> str:
    """What a build read, dropped and kept, its clusters, and its rows by source, label and split."""
    kept = stats["kept"]
    lines = [f"Dataset: {out or 'not written'}", f"Messages read: {stats['parsed']}, kept: {kept}", "Dropped:"]
    lines += _rows((text, stats.get(name, 0)) for name, text in DROPS.items())
    if stats.get("skipped_unknown_source"):
        lines.append(f"Folders of no known source: {', '.join(stats['skipped_unknown_source'])}")
    lines += [f"Near-duplicate clusters (Jaccard {stats.get('near_threshold')}):"]
    lines += _rows([("with several members", stats.get("near_clusters", 0)), ("largest", stats.get("near_largest", [])), ("in several splits (must be 0)", stats.get("near_clusters_leaked", 0)), ("components of mixed labels", stats.get("mixed_label_components", 0))])
    for title, name in (("By source:", "by_source"), ("By label:", "by_label"), ("By source and split:", "by_source_split")):
        lines += [title, *_rows(sorted(stats.get(name, {}).items()))]
    shares = stats.get("by_split", {})
    lines += ["By split:", *_rows((s, f"{shares[s]} ({100 * shares[s] / (kept or 1):.1f} %)") for s in SPLITS if s in shares)]
    lines += ["By source, label and split:", *_table(stats.get("by_source_label_split", {}))]
    hard = stats.get("hard_ham_by_split", {})
    lines += ["Hard legitimate mail by split:", *_rows([*((s, hard.get(s, 0)) for s in SPLITS), ("total", sum(hard.values()))])]
    return "\n".join(lines)


def import_report(stats: Mapping, dry_run: bool = False) -> str:
    """What an import accepted of each class and dropped, and how long texts are beside real ones."""
    lines = ["Import" + (", dry run: nothing written" if dry_run else ""), "Accepted by class:"]
    lines += _rows((c, f"{n} of {stats['generated'][c]}") for c, n in stats["accepted"].items())
    lines += ["Accepted by label:", *_rows(stats["by_label"].items()), "Dropped:"]
    lines += _rows([("known or repeated", stats["dropped_dup"]), ("empty", stats["dropped_empty"]), ("failed", stats["failed"])])
    lines += ["Characters of a text:", *_rows((kind, f"n={x['n']} mean={x['mean']:.0f} median={x['median']:.0f}") for kind, x in stats["lengths"].items())]
    return "\n".join(lines)
