"""Public suffixes: a list in the usual file format, read into a trie and compiled to patterns that the JVM evaluates.

The list is reference data like a vocabulary: some 10,000 rules, read on the driver once and sent along as two patterns. A host's
longest suffix is found in one match: labels are skipped from the left as few as possible, so the first suffix met is the
longest. The trie keeps rules of a common beginning together, so a match reads each character of a host about once a label.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

#: Where Debian's package keeps the list; FACTLOOM_SUFFIXES names another file.
USUAL_PATH = "/usr/share/publicsuffix/public_suffix_list.dat"
PRIVATE = "===BEGIN PRIVATE DOMAINS==="
#: Commonest endings; where no rule is longer, two labels are the answer without the large pattern.
COMMON = ("com", "net", "org")


def list_path() -> str | None:
    """The list's file, or None if there is none on this machine."""
    path = os.environ.get("FACTLOOM_SUFFIXES", USUAL_PATH)
    return path if os.path.exists(path) else None


def read_rules(text: str, private: bool = False) -> list[str]:
    """Rules of a suffix file; those of private owners (blogs, hosters) only if asked for."""
    if not private:
        text = text.split(PRIVATE)[0]
    lines = (line.split()[0] if line.split() else "" for line in text.splitlines())
    return [rule.lower().strip(".") for rule in lines if rule and not rule.startswith("//")]


def spellings(rule: str) -> set[str]:
    """A rule, and the same in the ASCII form of its labels."""
    coded = []
    for label in rule.split("."):
        try:
            coded.append(label if label.isascii() else label.encode("idna").decode())
        except UnicodeError:
            return {rule}
    return {rule, ".".join(coded)}


def trie_pattern(rules: set[str]) -> str:
    """One pattern for all rules, with common beginnings joined; a * is any label."""
    root: dict = {}
    for rule in rules:
        node = root
        for c in rule:
            node = node.setdefault(c, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        if list(node) == [""]:
            return ""
        said = []
        for c in sorted(x for x in node if x):
            said.append(("[^.]+" if c == "*" else re.escape(c)) + pattern(node[c]))
        out = said[0] if len(said) == 1 else f"(?:{'|'.join(said)})"
        return f"(?:{out})?" if "" in node else out

    return pattern(root)


class Suffixes:
    """Patterns of a list of rules.

    `split` puts a bar between the label above the longest suffix and the suffix ("" before it if the host is a suffix itself, the
    host as it is if it has none). `exceptions` finds hosts at or below a rule that begins with "!", which are no suffixes.
    `common` are the endings that have no longer rules.
    """

    def __init__(self, rules: list[str]):
        plain = {s for r in rules if not r.startswith("!") for s in spellings(r)}
        excepted = {s for r in rules if r.startswith("!") for s in spellings(r[1:])}
        self.split = rf"^(?:[^.]+\.)*?(|[^.]+\.)({trie_pattern(plain)})$"
        self.exceptions = rf"(?:^|\.)({trie_pattern(excepted)})$" if excepted else None
        longer = {r.rpartition(".")[2] for r in plain if "." in r}
        self.common = [x for x in COMMON if x in plain and x not in longer]


@lru_cache(maxsize=4)
def listed(path: str, private: bool = False) -> Suffixes:
    with open(path, encoding="utf-8") as f:
        return Suffixes(read_rules(f.read(), private))


@lru_cache(maxsize=8)
def given(rules: tuple[str, ...]) -> Suffixes:
    return Suffixes(list(rules))


@lru_cache(maxsize=1)
def usual_rules() -> Suffixes:
    """In place of a list: every last label, and the usual second levels below the two-letter ones."""
    from factloom.functions.tables import SECOND_LEVELS, SUFFIXES

    return Suffixes(["*", *SUFFIXES, *[f"{s}.{c}{d}" for s in SECOND_LEVELS for c in "abcdefghijklmnopqrstuvwxyz" for d in "abcdefghijklmnopqrstuvwxyz"]])
