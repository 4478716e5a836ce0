"""Secrets: all rules compiled into one minimal deterministic automaton.

A small parser turns the rules' regexes into one nondeterministic automaton; subset construction
over byte classes and minimisation by partition refinement make it deterministic. Two such
tables come from all rules together:

- The searching one takes every text's bytes once. A row that has seen a whole secret keeps itself,
  so most texts, which hold none, cost one lookup per byte.
- The placing one reads from the start of a match. Its states carry the set of rules that end there
  and the set that can still end. Texts that the first one accepts are read by it from left to right, for
  all rules in one pass: at a byte where some rule may begin, it goes on while a wanted rule
  can still end, notes each rule's last end, and a rule that has matched is not wanted again before its end.

So places are leftmost, longest and non-overlapping per rule. A null text is empty and has no span.
Rows are documents; ids may repeat or be null. Places are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import operator
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import map_arrow, mix64, whole_text

_KEY = "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
_ASSIGN = _KEY + r"""["']?\x20*[:=]\x20*["']?"""


@dataclass(frozen=True)
class Rule:
    """``match`` gives the places; a text without ``sign`` has none that is valid."""

    kind: str
    match: str
    sign: str
    least: int = 0  # of the match, or of the value that is assigned


# The three base rules, then public formats that the method adds.
RULES = (
    Rule("assign", _ASSIGN + "[A-Za-z0-9+/_.=-]+", _ASSIGN + "[A-Za-z0-9+/_.=-]{8}", 8),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{12}", 16),
    Rule("hex", "[0-9a-f]+", "[0-9a-f]{32}", 32),
    Rule("github", "gh[opsu]_[A-Za-z0-9]+", "gh[opsu]_[A-Za-z0-9]{36}", 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", "xox[abprs]-[A-Za-z0-9-]{10}", 15),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")


class _Nfa:
    """Thompson construction, straight from the text of a regex.

    Rules use characters, ``\\x..``, classes, groups, ``|``, ``?``, ``*``, ``+`` and ``{n}``.
    """

    def __init__(self) -> None:
        self.jumps: list[list[int]] = []
        self.reads: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.jumps.append([])
        self.reads.append([])
        return len(self.jumps) - 1

    def add(self, pattern: str, at: int) -> int:
        """The state in which the whole pattern has been read from ``at`` on."""
        tree, rest = _either(pattern)
        if rest:
            raise ValueError(f"the rule {pattern!r} has a bracket too many")
        return self.build(tree, at)

    def build(self, tree: tuple, at: int) -> int:
        kind, *parts = tree
        if kind == "read":
            out = self.state()
            self.reads[at].append((parts[0], out))
            return out
        if kind == "row":
            for part in parts[0]:
                at = self.build(part, at)
            return at
        out = self.state()
        if kind == "either":
            for part in parts[0]:
                self.jumps[self.build(part, at)].append(out)
            return out
        part, least, most = parts
        for _ in range(least):
            at = self.build(part, at)
        self.jumps[at].append(out)
        if most is None:
            self.jumps[self.build(part, out)].append(out)
        for _ in range((most or least) - least):
            at = self.build(part, at)
            self.jumps[at].append(out)
        return out

    def closed(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.jumps[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


REPEATS = {"?": (0, 1), "*": (0, None), "+": (1, None)}


def _either(text: str) -> tuple[tuple, str]:
    """Alternatives up to a closing bracket or the end, and the rest of the text."""
    options, row = [], []
    while text and text[0] != ")":
        if text[0] == "|":
            options.append(("row", row))
            row, text = [], text[1:]
            continue
        part, text = _part(text)
        if text and text[0] in REPEATS:
            part, text = ("repeat", part, *REPEATS[text[0]]), text[1:]
        elif text and text[0] == "{":
            times, text = text[1:].split("}", 1)
            part = ("repeat", part, int(times), int(times))
        row.append(part)
    return (("either", [*options, ("row", row)]) if options else ("row", row)), text


def _part(text: str) -> tuple[tuple, str]:
    """A group, a class or one character, and the rest of the text."""
    if text[0] == "(":
        tree, rest = _either(text[1:])
        if not rest:
            raise ValueError(f"a bracket of {text!r} stays open")
        return tree, rest[1:]
    if text[0] != "[":
        byte, rest = _byte(text)
        return ("read", frozenset([byte])), rest
    members: set[int] = set()
    text = text[1:]
    while text[0] != "]":
        low, text = _byte(text)
        high = low
        if text[0] == "-" and text[1] != "]":
            high, text = _byte(text[1:])
        members |= set(range(low, high + 1))
    return ("read", frozenset(members)), text[1:]


def _byte(text: str) -> tuple[int, str]:
    if text[0] != "\\":
        return ord(text[0]), text[1:]
    if text[1] == "x":
        return int(text[2:4], 16), text[4:]
    return ord(text[1]), text[2:]


@dataclass(frozen=True)
class Automaton:
    """``table[state, classes[byte]]`` is the next state; 0 is the start.

    ``accepts`` has a bit for each pattern that ends in the state.
    """

    classes: np.ndarray
    table: np.ndarray
    accepts: np.ndarray


@lru_cache(maxsize=32)
def compile_rules(patterns: tuple[str, ...], anchored: bool) -> Automaton:
    """One minimal automaton of all patterns.

    Anchored, it reads from the start of a match, and state -1 is where none can follow. Else
    it searches, and a state that has seen a match leads to itself only.
    """
    nfa = _Nfa()
    start = nfa.state()
    ends = [nfa.add(p, start) for p in patterns]
    marks: dict[tuple, list[int]] = {}
    sets = {symbols for reads in nfa.reads for symbols, _ in reads}
    ordered = sorted(sets, key=sorted)
    for byte in range(256):
        marks.setdefault(tuple(byte in s for s in ordered), []).append(byte)
    classes = np.zeros(256, np.uint8)
    samples = []
    for k, members in enumerate(marks.values()):
        classes[members] = k
        samples.append(members[0])

    # Sets of states are bit masks: steps[s][c] is all that s leads to on class c.
    steps = []
    for reads in nfa.reads:
        steps.append([_mask(nfa.closed([to for symbols, to in reads if b in symbols])) for b in samples])
    final = _mask(set(ends))
    first = _mask(nfa.closed([start]))
    numbers, todo, rows, accepts = {first: 0}, [first], [], []
    while len(rows) < len(todo):
        now = todo[len(rows)]
        number = len(rows)
        accepts.append(_mask(k for k, end in enumerate(ends) if anchored and now >> end & 1))
        if now & final and not anchored:
            accepts[-1] = 1
            rows.append([number] * len(samples))
            continue
        targets = [0 if anchored else first] * len(samples)
        for s in _bits(now):
            targets = list(map(operator.or_, targets, steps[s]))
        row = []
        for target in targets:
            if not target:
                row.append(-1)
                continue
            if not anchored and target & final:
                target = final  # all seen matches are alike
            if target not in numbers:
                numbers[target] = len(todo)
                todo.append(target)
            row.append(numbers[target])
        rows.append(row)
    return _minimal(classes, np.array(rows, np.int64), np.array(accepts, np.int64))


def _mask(states) -> int:
    return sum(1 << s for s in states)


def _bits(mask: int):
    while mask:
        low = mask & -mask
        yield low.bit_length() - 1
        mask ^= low


def _minimal(classes: np.ndarray, table: np.ndarray, accepts: np.ndarray) -> Automaton:
    """Merge states that no input tells apart: refine by acceptance, then by successors."""
    weights = mix64(np.arange(1, table.shape[1] + 2, dtype=np.uint64))
    part = accepts.copy()
    count = 0
    while True:
        successors = np.where(table >= 0, part[table], -1)
        rows = np.column_stack([part, successors])
        _, first, part = np.unique(
            mix64(rows.astype(np.uint64) + np.uint64(2)) @ weights, return_index=True, return_inverse=True
        )
        if (rows != rows[first[part]]).any():
            raise RuntimeError("two rows of states have one hash")
        if len(first) == count:
            break
        count = len(first)
    names = np.full(count, -1, np.int64)  # numbered as met, so that the start is 0
    names[part[np.sort(np.unique(part, return_index=True)[1])]] = np.arange(count)
    part = names[part]
    keep = np.unique(part, return_index=True)[1]
    merged = np.where(table[keep] >= 0, part[table[keep]], -1)
    return Automaton(classes, merged, accepts[keep])


def linked_rows(automaton: Automaton) -> tuple[list, list]:
    """Transition rows that hold each other, so that a step is one lookup.

    Returns the row of the start and that of a seen match. Rows end with whether they accept.
    """
    rows: list[list] = [[] for _ in automaton.accepts]
    for row, targets in zip(rows, automaton.table.tolist(), strict=True):
        row.extend(None if t < 0 else rows[t] for t in targets)
    seen = [row for row, accept in zip(rows, automaton.accepts, strict=True) if accept]
    return rows[0], seen[0]


def _can_end(automaton: Automaton) -> np.ndarray:
    """For each state the patterns that can end there or further on, as bits."""
    reach = automaton.accepts.copy()
    while True:
        ahead = np.where(automaton.table >= 0, reach[automaton.table], 0)
        new = reach | np.bitwise_or.reduce(ahead, axis=1)
        if (new == reach).all():
            return reach
        reach = new


class Placer:
    """Leftmost, longest, non-overlapping matches of each pattern, in one pass for all."""

    def __init__(self, automaton: Automaton):
        self.classes = automaton.classes.tobytes()
        self.table = automaton.table.tolist()
        self.accepts = automaton.accepts.tolist()
        self.can_end = _can_end(automaton).tolist()
        self.numbers = [
            [k for k in range(int(accept).bit_length()) if accept >> k & 1] for accept in self.accepts
        ]
        # Of each byte the patterns that can begin with it.
        self.begins = [self.can_end[t] if t >= 0 else 0 for t in self.table[0]]
        self.starters = re.compile(
            b"[" + b"".join(b"\\x%02x" % b for b in range(256) if self.begins[self.classes[b]]) + b"]"
        )

    def places(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, pattern, end) in order."""
        table, can_end, accepts, numbers = self.table, self.can_end, self.accepts, self.numbers
        read = data.translate(self.classes)
        n, out = len(read), []
        busy: dict[int, int] = {}  # pattern: end of its last match
        every = self.can_end[0]
        for found in self.starters.finditer(data):
            at = found.start()
            wanted = every
            for k, end in busy.items():
                if end > at:
                    wanted &= ~(1 << k)
            if not self.begins[read[at]] & wanted:
                continue
            state, k, ends = 0, at, {}
            while k < n:
                state = table[state][read[k]]
                if state < 0 or not can_end[state] & wanted:
                    break
                k += 1
                if accepts[state] & wanted:
                    for pattern in numbers[state]:
                        ends[pattern] = k
            for pattern, end in ends.items():
                if wanted >> pattern & 1:
                    out.append((at, pattern, end))
                    busy[pattern] = end
        return sorted(out)


def _long_enough(rule: Rule, found: bytes) -> bool:
    if rule.kind != "assign":
        return len(found) >= rule.least
    value = found[min(p for p in (found.find(b":"), found.find(b"=")) if p >= 0) + 1 :].lstrip(b" ")
    return len(value) - (value[:1] in (b'"', b"'")) >= rule.least


def _code_points(data: bytes) -> Callable[[int], int]:
    """From byte places to code points; counted once for a text."""
    if data.isascii():
        return lambda at: at
    starts = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    counts = np.append(0, np.cumsum(starts))
    return lambda at: int(counts[at])


def _scan(rules: tuple[Rule, ...]):
    search = compile_rules(tuple(r.sign for r in rules), anchored=False)
    automaton = compile_rules(tuple(r.match for r in rules), anchored=True)
    empty = hashlib.sha256(b"").hexdigest()

    def work(batch: pa.RecordBatch):
        classes = search.classes.tobytes()
        start, seen = linked_rows(search)
        placer = Placer(automaton)
        step = operator.getitem
        counts = np.zeros((batch.num_rows, len(rules)), np.int64)
        prints, texts = [empty] * batch.num_rows, [""] * batch.num_rows
        for row, text in enumerate(batch.column("text")):
            data = text.as_py().encode("utf-8", "surrogatepass")
            if reduce(step, data.translate(classes), start) is not seen:
                continue
            point = _code_points(data)
            found = [
                (point(s), k, e - s)
                for s, k, e in placer.places(data)
                if _long_enough(rules[k], data[s:e])
            ]
            listed = [(rules[k].kind, f"{rules[k].kind}:{s}:{s + n}") for s, k, n in found]
            for _, k, _ in found:
                counts[row, k] += 1
            base = ",".join(t for kind, t in listed if kind in BASE)
            prints[row] = hashlib.sha256(base.encode()).hexdigest()
            texts[row] = ",".join(t for _, t in listed)
        names = {f"n_{r.kind}": counts[:, k] for k, r in enumerate(rules)}
        yield pa.record_batch(
            {"doc_id": batch.column("doc_id")} | names | {"base_sha256": prints, "spans": texts}
        )

    return work


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, ``n_<kind>`` per rule, ``base_sha256``, ``spans``; one row per row of ``docs``."""
    counts = ", ".join(f"n_{r.kind} bigint" for r in rules)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return map_arrow(texts, _scan(rules), f"doc_id bigint, {counts}, base_sha256 string, spans string")
