"""Branch conditions of program text: parsed to a tree, simplified by rule, printed again.

A condition is an OR of ANDs of relations; brackets that open after an operand belong to the relation. Rules:
  shorthand       X = 'I' OR 'A'                 X = 'I' OR X = 'A'
  double negation NOT (A NOT GREATER B)          A GREATER B (also LESS)
  one field       X = 'I' AND X = 'A'            X = 'I' OR X = 'A': a field can't be both, either was meant
  contradiction   NOT (X = 'I') AND X = 'I'      dropped: the branch is never taken
  repeats         A OR B OR A                    A OR B
  more specific   A OR (A AND B)                 A AND B: the narrower guard is what the branch reports
Unbalanced brackets are closed at the end.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(r"'[^']*'?|\"[^\"]*\"?|[()]|[^\s()'\"]+")
_LITERAL = re.compile(r"'[^']*'|\"[^\"]*\"|[+-]?\d+(\.\d+)?")
_EQUALS = re.compile(r"(\S+) = ('[^']*')", re.I)

# A node is ("rel", text), ("not", node), ("and", nodes) or ("or", nodes).


def tidy(text: str) -> str:
    """One blank between words; no full stop, comma, AND or OR at the end."""
    text = " ".join((text or "").split()).rstrip(".").rstrip(",")
    return re.sub(r"\s*\b(AND|OR)$", "", text, flags=re.I).strip()


def parse(text: str):
    tokens = _TOKEN.findall(tidy(text))
    at = 0

    def peek():
        return tokens[at].upper() if at < len(tokens) else ""

    def take():
        nonlocal at
        at += 1
        return tokens[at - 1]

    def several(word, lower):
        parts = [lower()]
        while peek() == word:
            take()
            parts.append(lower())
        parts = [p for p in parts if p is not None]
        return parts[0] if len(parts) == 1 else (word.lower(), parts) if parts else None

    def either():
        return several("OR", both)

    def both():
        return several("AND", one)

    def one():
        if peek() == "NOT":
            take()
            inner = one()
            return None if inner is None else ("not", inner)
        if peek() == "(":
            take()
            inner = either()
            if peek() == ")":
                take()
            return inner
        words = []
        while at < len(tokens) and peek() not in ("AND", "OR", ")"):
            if peek() == "(":  # a subscript: it belongs to the operand before it
                depth, piece = 0, ""
                while at < len(tokens):
                    t = take()
                    depth += (t == "(") - (t == ")")
                    piece += t if t in "()" or piece.endswith("(") else " " + t
                    if not depth:
                        break
                words[-1] += piece
            else:
                words.append(take())
        return ("rel", " ".join(words)) if words else None

    tree = either()
    while at < len(tokens):  # what a stray bracket cut off
        take()
        rest = either()
        tree = rest if tree is None else tree if rest is None else ("and", [tree, rest])
    return tree


def _same(a, b) -> bool:
    return show(a).upper() == show(b).upper()


def _flat(kind, parts):
    for p in parts:
        if p[0] == kind:
            yield from _flat(kind, p[1])
        else:
            yield p


def _unique(parts):
    out = []
    for p in parts:
        if not any(_same(p, q) for q in out):
            out.append(p)
    return out


def simplify(tree):
    """The tree after the rules; None if nothing is left."""
    if tree is None or tree[0] == "rel":
        return tree
    if tree[0] == "not":
        inner = simplify(tree[1])
        if inner is None:
            return None
        if inner[0] == "rel" and (m := re.fullmatch(r"(\S+) NOT (GREATER|LESS) (\S+)", inner[1], re.I)):
            return ("rel", f"{m[1]} {m[2]} {m[3]}")
        return ("not", inner)
    if tree[0] == "or":
        parts, subject = [], None
        for p in _flat("or", tree[1]):
            if p[0] == "rel" and subject and _LITERAL.fullmatch(p[1]):
                p = ("rel", f"{subject} {p[1]}")
            elif p[0] == "rel":
                m = re.fullmatch(r"(.*\S\s+=)\s*\S+", p[1])
                subject = m[1] if m else None
            else:
                subject = None
            p = simplify(p)
            if p is not None:
                parts.append(p)
        parts = _unique(_flat("or", parts))
        kept = [p for p in parts if not any(q[0] == "and" and _same(q[1][0], p) for q in parts)]
        return None if not kept else kept[0] if len(kept) == 1 else ("or", kept)
    parts = _unique(_flat("and", [q for p in tree[1] if (q := simplify(p)) is not None]))
    equals = {}
    for p in parts:
        if p[0] == "rel" and (m := _EQUALS.fullmatch(p[1])):
            equals.setdefault(m[1].upper(), []).append(p)
    for p in parts:
        if p[0] == "not" and any(_same(p[1], q) for own in equals.values() for q in own):
            return None
    out, done = [], set()
    for p in parts:
        own = next((k for k, v in equals.items() if any(p is q for q in v)), None)
        if own is None or len(equals[own]) == 1:
            out.append(p)
        elif own not in done:
            done.add(own)
            out.append(("or", equals[own]))
    return None if not out else out[0] if len(out) == 1 else ("and", out)


def show(tree, top: bool = False) -> str:
    """Text of a tree. Alternatives stand in brackets at the top, groups in brackets inside others."""
    if tree is None:
        return ""
    if tree[0] == "rel":
        return tree[1]
    if tree[0] == "not":
        return f"NOT ({show(tree[1])})"
    inner = [f"({show(p)})" if (top and tree[0] == "or") or p[0] in ("and", "or") else show(p) for p in tree[1]]
    return f" {tree[0].upper()} ".join(inner)


def simplified(text: str) -> str:
    return show(simplify(parse(text)), top=True)


# --- branches ----------------------------------------------------------------------------------------

_GO = re.compile(r"\bGO\s+TO\s+([A-Z0-9-]+)", re.I)
_LABEL = re.compile(r"\s*[A-Z0-9-]+\.\s*", re.I)
SCAN = 25


class Branches:
    """The stack of open IFs over a paragraph's lines, and for each GO TO the condition under which it is reached.

    A full stop closes the innermost IF, but not the one of a GO TO: an IF whose statements end in one stays open.
    """

    def __init__(self, lines: list[str]):
        self.lines = [s for s in (x.rstrip() for x in lines) if s.strip() and not s.strip().startswith("*")]
        self.open: list = []
        self.guards: list = []
        self.found: dict[str, object] = {}
        at = 0
        while at < len(self.lines):
            at = self._line(at)

    def _line(self, at: int) -> int:
        line = self.lines[at]
        upper = line.strip().upper()
        if re.search(r"\bEND-IF\b", upper):
            if self.open:
                self.open.pop()
        elif re.match(r"ELSE\b", upper):
            if self.open:
                self.open.append(("not", self.open.pop()))
        elif re.match(r"IF\b", upper):
            return self._if(at)
        elif m := _GO.search(upper):
            if self.open:
                self._reach(m[1], self._all())
            elif self.guards:  # after a ladder of guards: none of them held
                self._reach(m[1], ("not", ("or", self.guards) if len(self.guards) > 1 else self.guards[0]))
                self.guards = []
        elif line.endswith(".") and self.open:
            self.open.pop()
        return at + 1

    def _all(self, extra=None):
        parts = [p for p in (*self.open, extra) if p is not None]
        return parts[0] if len(parts) == 1 else ("and", parts) if parts else None

    def _reach(self, target: str, tree) -> None:
        tree = simplify(tree)
        if tree is None:
            return
        target = target.rstrip(".").rstrip(",")
        known = self.found.get(target)
        self.found[target] = tree if known is None else simplify(("or", [known, tree]))

    def _if(self, at: int) -> int:
        """An IF's condition may run over lines; its GO TO stands on the same, the next, or a later line of its sentence."""
        text = re.sub(r"^\s*IF\b", "", self.lines[at], flags=re.I)
        text = re.split(r"\bTHEN\b|\bGO\s+TO\b", text, flags=re.I)[0]
        after = at + 1
        while after < len(self.lines):
            line = self.lines[after].strip()
            joins = re.search(r"\b(AND|OR)\s*$", text, re.I) or re.match(r"(AND|OR)\b", line, re.I)
            if not joins or re.match(r"(GO\s+TO|PERFORM|ELSE|END-IF)\b", line, re.I) or _LABEL.fullmatch(line):
                break
            text += " " + re.split(r"\bTHEN\b", line, flags=re.I)[0]
            after += 1
        condition = simplify(parse(text))
        here = _GO.search(self.lines[at].upper())
        target, end = (here[1], after) if here else self._goto(after)
        if target:
            if not self.open and condition is not None:
                self.guards.append(condition)
            self._reach(target, self._all(condition))
            return end
        if not self.open:
            self.guards = []
        self.open.append(condition)
        return after

    def _goto(self, at: int):
        if at < len(self.lines) and (m := _GO.search(self.lines[at].upper())):
            return m[1], at + 1
        for k in range(at, min(at + SCAN, len(self.lines))):
            line = self.lines[k].strip().upper()
            if line.endswith(".") or re.match(r"(IF|END-IF|ELSE)\b", line) or _LABEL.fullmatch(line):
                break
            if m := _GO.search(line):
                return m[1], k + 1
        return None, at


def branch_conditions(lines: list[str]) -> dict[str, str]:
    """Target to condition for the GO TOs of a paragraph; unconditional ones have none."""
    return {t: show(tree, top=True) for t, tree in Branches(lines).found.items()}


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("target", T.StringType()), T.StructField("condition", T.StringType())])))
def branch_conditions_udf(lines: pd.Series) -> pd.Series:
    """Arrow: one paragraph's lines, in order, are one row; nothing outside it matters."""
    return lines.map(lambda x: [{"target": t, "condition": c} for t, c in branch_conditions(list(x)).items()])


@F.pandas_udf(T.StringType())
def simplified_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else simplified(t))
