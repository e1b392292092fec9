"""A valid root has no findings; each broken rule is found by its code, with its severity."""

import pytest

from quarry.plans import validate

TABLE = """---
type: table
name: CORE.album
description: Albums
description_confirmed: false
database: MUSIC
engine: ansi
row_count: 3
row_count_source: live
crawl_date: 2020-01-01
flags: []
---

- [inferred:high] Purpose: albums.

## Columns

### album_id
- [observed] type: INT, not null
- [observed] distinct_count: 3; null_rate: 0.0  # source: stats
- [observed] fingerprint: sha256/8B @ fingerprints/CORE.album.album_id.json
- [observed] normalization: [none]
- [inferred:high] Identifier.

### title
- [observed] type: TEXT
- [observed] sensitive: true
- [observed] fingerprint: suppressed (sensitive)
- [inferred:low] insufficient evidence
"""
INDEX = """---
type: index
database: MUSIC
description: Music.
build_date: 2020-01-01
completeness: COMPLETE  # all seen
---

- [inferred:high] Music catalog. It has albums. Nothing else.

## Tables

- `CORE/album.md` — Albums (3 rows)
"""
PAIR_INDEX = """---
type: index
databases: [MUSIC, SALES]
description: Edges.
build_date: 2020-01-02
completeness: COMPLETE
---

- [inferred:high] Edges of two databases.

## Table pairs

- `album--line.md` — 1 candidate
"""
RELATION = """---
type: relationship
tables: [MUSIC.CORE.album, SALES.S.line]
built_from: [db/MUSIC@2020-01-01, db/SALES@2020-01-01]
---

## album.album_id <-> line.album_id
- [observed] containment: 1.0
- [inferred:medium] Likely join.
"""
PAYLOAD = '{"algo": "sha256-64", "normalization": ["none"], "sample_cap": 5000, "count": 1, "hashes": ["00"]}'
GOOD = {
    "db/MUSIC/index.md": INDEX, "db/MUSIC/CORE/album.md": TABLE, "db/MUSIC/fingerprints/CORE.album.album_id.json": PAYLOAD,
    "db/SALES/index.md": INDEX.replace("MUSIC", "SALES").replace("CORE/album.md", "S/line.md").replace("Albums", "Lines"),
    "db/SALES/S/line.md": TABLE.replace("MUSIC", "SALES").replace("CORE.album", "S.line").replace("Albums", "Lines"),
    "db/SALES/fingerprints/S.line.album_id.json": PAYLOAD,
    "rel/MUSIC--SALES/index.md": PAIR_INDEX, "rel/MUSIC--SALES/album--line.md": RELATION,
}
T, I, P, R, J = "db/MUSIC/CORE/album.md", "db/MUSIC/index.md", "rel/MUSIC--SALES/index.md", "rel/MUSIC--SALES/album--line.md", "db/MUSIC/fingerprints/CORE.album.album_id.json"

BROKEN = [
    ("P001", T, "[observed] type: INT", "[guessed] type: INT"), ("P002", T, "[inferred:high] Identifier", "[inferred] Identifier"), ("P002", T, "[inferred:high] Identifier", "[inferred:sure] Identifier"),
    ("P003", T, "[observed] type: INT", "[observed:high] type: INT"), ("T001", T, "engine: ansi\n", ""), ("T001", T, "engine: ansi", "engine:"), ("T002", T, "name: CORE.album", "name: album"),
    ("T003", T, "description: Albums\n", "description: Albums\nand more\n"), ("T004", T, "confirmed: false", "confirmed: maybe"), ("T005", T, "row_count: 3", "row_count: -1"), ("T006", T, "flags: []", "flags: junk"),
    ("T007", T, TABLE[TABLE.index("### album_id"):], ""), ("T008", T, "### title", "### album_id"), ("T009", T, "### title", "### more\n\n### title"), ("T010", T, "- [inferred:low] insufficient evidence\n", ""),
    ("T011", T, "- [observed] sensitive: true", "- [observed] sensitive: true\n- [observed] top_values: [1]"), ("T012", T, "### album_id\n", "### album_id\n- [observed] sensitive: true\n"), ("T013", T, "database: MUSIC", "database: OTHER"),
    ("T014", T, "name: CORE.album", "name: CORE.song"), ("T015", T, "fingerprints/CORE.album.album_id.json", "fingerprints/CORE.album.gone.json"), ("T016", T, "fingerprints/CORE", "/fingerprints/CORE"), ("T017", J, PAYLOAD, "not json"),
    ("T018", T, "normalization: [none]", "normalization: [trim]"), ("T019", T, "fingerprints/CORE.album", "fingerprints/album"), ("T020", T, "suppressed (sensitive)", "suppressed (whim)"), ("T021", T, "suppressed (sensitive)", "hidden"),
    ("R001", R, "tables: [MUSIC.CORE.album, SALES.S.line]\n", ""), ("R002", R, ", SALES.S.line", ""), ("R003", R, "SALES.S.line", "SALES.line"), ("R004", R, "db/SALES@2020-01-01", "db/SALES"), ("R005", R, RELATION[RELATION.index("## album"):], ""),
    ("R006", R, "## album.album_id", "## empty\n\n## album.album_id"), ("R007", R, "SALES.S.line", "OTHER.S.line"), ("I001", I, "description: Music.\n", ""), ("I002", I, "database: MUSIC\n", ""), ("I003", P, "[MUSIC, SALES]", "[MUSIC]"),
    ("I004", P, "[MUSIC, SALES]", "[SALES, MUSIC]"), ("I005", I, "COMPLETE  #", "DONE  #"), ("I006", I, "- [inferred:high] Music catalog. It has albums. Nothing else.\n", ""), ("I007", I, " It has albums. Nothing else.", ""),
    ("I008", I, "- `CORE/album.md` — Albums (3 rows)\n", ""), ("I009", I, "- `CORE/album.md` — Albums (3 rows)", "- `CORE/album.md` — Albums\n- `CORE/album.md` — Albums"), ("I010", I, "`CORE/album.md`", "`/CORE/album.md`"),
    ("I011", I, "Albums (3 rows)", ""), ("I012", I, "(3 rows)", "x" * 130), ("D001", T, "type: table", "type: index"), ("B001", I, "database: MUSIC", "database: OTHER"),
    ("B002", T, "- [observed] fingerprint: sha256/8B @ fingerprints/CORE.album.album_id.json\n", ""), ("B005", P, "[MUSIC, SALES]", "[MUSIC, OTHER]"), ("B006", I, "- `CORE/album.md` — Albums (3 rows)\n", "- `CORE/other.md` — x\n"),
    ("B007", I, "`CORE/album.md`", "`CORE/gone.md`"), ("B008", I, "Albums (3 rows)", "Songs"), ("X001", R, "db/SALES@2020-01-01", "db/GONE@2020-01-01"), ("X002", R, "db/SALES@2020-01-01", "db/SALES@2019-01-01"), ("X003", I, "COMPLETE  #", "INCOMPLETE  #"),
]


@pytest.fixture(scope="module")
def findings(spark):
    """Findings of all broken roots in one job: each root's databases carry its number, so that they cannot meet."""
    roots = [("good", GOOD)]
    for k, (_, path, old, new) in enumerate(BROKEN):
        assert old in GOOD[path]
        roots.append((k, GOOD | {path: GOOD[path].replace(old, new, 1)}))
    roots.append(("B003", {k.replace("MUSIC--SALES", "MUSIC"): v for k, v in GOOD.items()}))
    roots.append(("B004", {k.replace("MUSIC--SALES", "SALES--MUSIC"): v for k, v in GOOD.items()}))
    rows = []
    for name, files in roots:
        mark = lambda x: x.replace("MUSIC", f"MUSIC{name}").replace("SALES", f"SALES{name}").replace("GONE", f"GONE{name}")  # noqa: B023, E731
        rows += [(mark(p), mark(t) if p.endswith(".md") else t) for p, t in files.items()]
    found = validate.validate(spark.createDataFrame(rows, "path string, text string")).collect()
    by_root: dict = {str(name): set() for name, _ in roots}
    for r in found:
        mark = r["path"].split("/")[1].removeprefix("SALES").removeprefix("MUSIC").split("--")[0]
        by_root[mark].add((r["code"], r["severity"]))
    return by_root


def test_a_valid_root_has_no_findings(findings):
    assert findings["good"] == set()


def test_every_rule_is_found(findings):
    for k, (code, path, old, _) in enumerate(BROKEN):
        assert (code, "warning" if code in ("I007", "I012", "X001") else "error") in findings[str(k)], (code, path, old)
    assert ("B003", "error") in findings["B003"] and ("B004", "error") in findings["B004"]
    assert len({c for c, *_ in BROKEN} | {"B003", "B004"}) == 55


def test_files_are_read_from_a_folder(spark, tmp_path):
    for name, text in GOOD.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    files = validate.read(spark, f"file://{tmp_path}")
    assert {(r["path"], r["text"]) for r in files.collect()} == set(GOOD.items())
