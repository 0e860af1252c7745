"""Named SQL blocks and the WITH clause that a block needs."""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

HERE = Path(__file__).parent
SIDES = ("current", "target")


def _blocks(file: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for part in re.split(r"^-- name: ", (HERE / file).read_text(), flags=re.M)[1:]:
        name, body = part.split("\n", 1)
        body = "\n".join(l for l in body.splitlines() if not l.lstrip().startswith("--")).strip()
        for side in SIDES if "{x}" in name else ("",):
            out[name.strip().replace("{x}", side)] = body.replace("{x}", side)
    return out


@cache
def fixtures() -> dict[str, str]:
    return _blocks("fixtures.sql")


@cache
def oracles() -> dict[str, str]:
    return {n: b for f in sorted(p.name for p in HERE.glob("oracle_*.sql")) for n, b in _blocks(f).items()}


def with_clause(body: str, blocks: dict[str, str]) -> str:
    """``body`` behind a WITH clause of all the blocks it reads, directly or not."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b\w+\b", text)):
            if word in blocks and word not in order:
                visit_name(word)

    def visit_name(name: str) -> None:
        if name in order:
            return
        # a recursive block names itself
        deps = [w for w in dict.fromkeys(re.findall(r"\b\w+\b", blocks[name])) if w in blocks and w != name]
        for dep in deps:
            visit_name(dep)
        if name not in order:
            order.append(name)

    visit(body)
    if not order:
        return body
    recursive = "RECURSIVE " if any(re.search(rf"\b{n}\b", blocks[n]) for n in order) else ""
    return f"WITH {recursive}" + ",\n".join(f"{n} AS (\n{blocks[n]}\n)" for n in order) + f"\n{body}"


def reached(body: str, blocks: dict[str, str], ends: set[str]) -> set[str]:
    """The blocks that ``body`` reads, directly or through others than ``ends``."""
    found: set[str] = set()
    todo = [body]
    while todo:
        for name in (set(re.findall(r"\b\w+\b", todo.pop())) & blocks.keys()) - found:
            found.add(name)
            if name not in ends:
                todo.append(blocks[name])
    return found


def oracle(name: str) -> str:
    """One statement that DuckDB runs on the given tables."""
    blocks = {**fixtures(), **{n: b for n, b in oracles().items() if n != name}}
    return with_clause(oracles()[name], blocks)
