"""Profile documents: a line grammar with provenance tags, written, read and checked."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

TAGS = ("observed", "confirmed", "stale-confirmed")
LEVELS = ("high", "medium", "low")
LINE = re.compile(r"- \[(?P<tag>[a-z-]+)(?::(?P<level>\w+))?\] (?P<key>[a-z_-]+): (?P<value>.*)")
REQUIRED = ("type", "name", "description", "description_confirmed", "database", "engine", "crawl_date")


@dataclass
class Document:
    front: dict = field(default_factory=dict)
    columns: dict[str, list[tuple[str, str, str]]] = field(default_factory=dict)  # (tag, key, value)
    bad: list[str] = field(default_factory=list)

    def text(self) -> str:
        head = [f"{k}: {_scalar(v)}" for k, v in self.front.items()]
        body = [line for c, lines in self.columns.items() for line in ["", f"## {c}", *[f"- [{t}] {k}: {v}" for t, k, v in lines]]]
        return "\n".join(["---", *head, "---", *body]) + "\n"


def _scalar(v) -> str:
    if isinstance(v, bool):
        return str(v).lower()
    return f"[{', '.join(map(str, v))}]" if isinstance(v, (list, tuple)) else str(v)


def _parsed(text: str):
    if text in ("true", "false"):
        return text == "true"
    if re.fullmatch(r"-?\d+", text):
        return int(text)
    if text.startswith("[") and text.endswith("]"):
        return [p.strip() for p in text[1:-1].split(",") if p.strip()]
    return text


def read(text: str) -> Document:
    out, lines, at = Document(), text.split("\n"), 0
    if lines and lines[0] == "---":
        end = lines.index("---", 1)
        out.front = {k: _parsed(v) for k, _, v in (line.partition(": ") for line in lines[1:end])}
        at = end + 1
    name = None
    for line in lines[at:]:
        if line.startswith("## "):
            name = line[3:]
            if name in out.columns:
                out.bad.append(f"T008 {name}")
            out.columns.setdefault(name, [])
        elif m := LINE.fullmatch(line):
            tag = m["tag"] + (f":{m['level']}" if m["level"] else "")
            if name is not None:
                out.columns[name].append((tag, m["key"], m["value"]))
        elif line.strip():
            out.bad.append(f"T021 {line}")
    return out


def check(doc: Document) -> list[str]:
    """Codes of broken rules of one table document."""
    found = list(doc.bad)
    found += [f"T001 {k}" for k in REQUIRED if doc.front.get(k) in (None, "")]
    if len(str(doc.front.get("name", "")).split(".")) != 2:
        found.append("T002 name")
    if not isinstance(doc.front.get("description_confirmed"), bool):
        found.append("T004 description_confirmed")
    rows = doc.front.get("row_count")
    if rows is not None and (not isinstance(rows, int) or isinstance(rows, bool) or rows < 0):
        found.append("T005 row_count")
    if not isinstance(doc.front.get("flags", []), list):
        found.append("T006 flags")
    if not doc.columns:
        found.append("T007 columns")
    for name, lines in doc.columns.items():
        keys = [k for _, k, _ in lines]
        if not lines:
            found.append(f"T009 {name}")
        elif "description" not in keys:
            found.append(f"T010 {name}")
        if "sensitive" in keys:
            found += [f"{code} {name}" for code, k in (("T011", "top_values"), ("T012", "fingerprint")) if k in keys]
        for tag, _, _ in lines:
            kind, _, level = tag.partition(":")
            if kind not in (*TAGS, "inferred"):
                found.append(f"P001 {name}")
            elif kind == "inferred" and level not in LEVELS:
                found.append(f"P002 {name}")
            elif kind != "inferred" and level:
                found.append(f"P003 {name}")
    return found


def render(table: str, database: str, crawl_date: str, profile: list[dict], engine: str = "spark", listed: set[str] = frozenset()) -> Document:
    """A document of profile rows (column, type, n_rows, non_null, n_distinct, low, high, ...); sensitive columns show no values."""
    rows = profile[0]["n_rows"] if profile else 0
    flags = ["empty"] if not rows else []
    front = {"type": "table", "name": table, "description": f"Table {table}.", "description_confirmed": False, "database": database, "engine": engine}
    out = Document(front | {"row_count": rows, "row_count_source": "live", "crawl_date": crawl_date, "flags": flags})
    for p in profile:
        null_rate = round(1 - p["non_null"] / rows, 4) if rows else None
        lines = [("observed", "type", p["type"]), ("observed", "counts", f"rows={rows}; distinct={p['n_distinct']}; null_rate={null_rate}")]
        if p["column"] in listed:
            lines.append(("observed", "sensitive", "true"))
        else:
            if p.get("low") is not None:
                lines.append(("observed", "range", f"{p['low']} .. {p['high']}"))
            if p.get("top_values"):
                lines.append(("observed", "top_values", json.dumps(p["top_values"][:6])))
        if p.get("suppressed"):
            lines.append(("observed", "suppressed", p["suppressed"]))
        lines.append(("inferred:low", "description", "unknown"))
        out.columns[p["column"]] = lines
    return out


def payload(rules: list[str], cap: int, count: int, hashes: list[str]) -> str:
    return json.dumps({"algo": "sha256-64", "normalization": rules or ["none"], "sample_cap": cap, "count": count, "hashes": sorted(hashes)}, indent=1) + "\n"


def review_queue(doc: Document) -> list[tuple[str, str]]:
    """What a person should look at: guesses of low confidence, and confirmations that went stale."""
    return [(c, k) for c, lines in doc.columns.items() for t, k, _ in lines if t in ("inferred:low", "stale-confirmed")]
