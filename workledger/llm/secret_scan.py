"""Secret scans: all rules as one minimal automaton, read over the bytes in one pass.

The rules' expressions are compiled to one non-deterministic automaton, made
deterministic by subset construction and minimised by refining partitions. The
result is an array of transitions. It reads the bytes from the last to the first and
so tells, at every byte, which rules have a match that begins there; nothing
is ever tried at a byte that begins no match. Each match is then followed once, by its
rule's own automaton, to its end: leftmost, not overlapping, as long as possible.

Texts are cut into lanes at bytes after which the automaton is back at its start
from every state, so no match crosses a cut. Ordinary lanes are stepped
together to find those with a match; those, and lanes longer than ``LONG_LANE``,
are read byte by byte. Time is in proportion to the bytes, whatever they are, for rules
whose match can be told to end a bounded number of bytes behind it, as all rules here.

Defined cases: null and empty texts have no spans; equal rows give equal spans;
texts of any length are read whole; an empty table gives an empty result; input
columns named like an output are replaced.
"""

from __future__ import annotations

from re import _constants as sre, _parser as parser
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, types as T

from workledger.llm.common import append_columns


class Rule(NamedTuple):
    """``least`` is the shortest value kept; the value is what follows the expression's last ``(``, or the whole match."""

    kind: str
    pattern: str
    ignore_case: bool = False
    least: int = 1
    value: str = ""


# The base rules of the contract.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
VALUE = r"[A-Za-z0-9+/_.=-]"
BASE = (
    # Keys are matched in either case; ``value`` names the bytes that end the match.
    Rule("assign", "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in ASSIGN.partition('["')[0]) + ASSIGN[ASSIGN.index('["') :] + VALUE + "+", least=6, value=VALUE),
    # A run below the least length can hold no longer match, so the length is part of the rule.
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
ADDED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
)
RULES = BASE + ADDED

LANE = 512
LONG_LANE = 8 * LANE
LANES_AT_ONCE = 1 << 15

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


class _Nfa:
    """Thompson's construction over bytes; ``backwards`` for the matches read from their ends."""

    def __init__(self, backwards: bool = False):
        self.backwards = backwards
        self.free: list[list[int]] = []
        self.on: list[tuple[frozenset[int], int] | None] = []

    def state(self) -> int:
        self.free.append([])
        self.on.append(None)
        return len(self.free) - 1

    def add(self, parsed, start: int) -> int:
        """Append a parsed expression behind ``start``; returns where it ends."""
        for op, arg in reversed(list(parsed)) if self.backwards else parsed:
            if op is sre.LITERAL:
                start = self._byte({arg}, start)
            elif op is sre.IN:
                start = self._byte(_byte_set(arg), start)
            elif op is sre.SUBPATTERN:
                start = self.add(arg[-1], start)
            elif op is sre.BRANCH:
                end = self.state()
                for choice in arg[1]:
                    self.free[self.add(choice, start)].append(end)
                start = end
            elif op is sre.MAX_REPEAT:
                low, high, body = arg
                for _ in range(low):
                    start = self.add(body, start)
                if high is sre.MAXREPEAT:
                    loop = self.state()
                    self.free[start].append(loop)
                    self.free[self.add(body, loop)].append(loop)
                    start = loop
                else:
                    end = self.state()
                    for _ in range(high - low):
                        self.free[start].append(end)
                        start = self.add(body, start)
                    self.free[start].append(end)
                    start = end
            else:
                raise ValueError(f"a rule may not use {op}")
        return start

    def _byte(self, accepted: set[int], start: int) -> int:
        begin, end = self.state(), self.state()
        self.free[start].append(begin)
        self.on[begin] = (frozenset(accepted), end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for other in self.free[todo.pop()]:
                if other not in seen:
                    seen.add(other)
                    todo.append(other)
        return frozenset(seen)


def _byte_set(parts) -> set[int]:
    out = set()
    for op, arg in parts:
        if op is sre.LITERAL:
            out.add(arg)
        elif op is sre.RANGE:
            out.update(range(arg[0], arg[1] + 1))
        else:
            raise ValueError(f"a byte class may not use {op}")
    return out


class Automaton:
    """Transitions as one array (state, byte); per state a bit set of the rules that end there."""

    def __init__(self, rules: tuple[Rule, ...], anywhere: bool, backwards: bool = False):
        """``anywhere``: a match may begin at every byte that is read, else only at the first."""
        nfa = _Nfa(backwards)
        begin = nfa.state()
        ends = {}
        for n, rule in enumerate(rules):
            own = nfa.state()
            nfa.free[begin].append(own)
            ends[nfa.add(parser.parse(rule.pattern), own)] = n
        # Bytes that no rule tells apart are followed once.
        classes: dict[tuple[bool, ...], list[int]] = {}
        kinds = [accepted for accepted, _ in filter(None, nfa.on)]
        for byte in range(256):
            classes.setdefault(tuple(byte in accepted for accepted in kinds), []).append(byte)
        reach = [nfa.closure([s]) for s in range(len(nfa.free))]
        first = reach[begin]
        number, sets, rows = {first: 0}, [first], []
        for states in sets:  # grows while it is read
            row = np.zeros(256, np.int64)
            targets: dict[int, set[int]] = {alike[0]: set() for alike in classes.values()}
            for accepted, to in filter(None, (nfa.on[s] for s in states)):
                for byte in accepted & targets.keys():
                    targets[byte].add(to)
            for alike in classes.values():
                target = targets[alike[0]]
                closed = frozenset().union(*[reach[t] for t in (target | {begin} if anywhere else target)])
                if closed not in number:
                    number[closed] = len(sets)
                    sets.append(closed)
                row[alike] = number[closed]
            rows.append(row)
        accepts = np.array([sum({1 << ends[s] for s in states if s in ends}) for states in sets])
        self.step, self.accepts, self.start, dead = _minimal(np.array(rows), accepts, number.get(frozenset(), -1))
        self.dead = dead
        #: Bytes that lead back to the start from everywhere.
        self.resets = (self.step == self.start).all(0) if anywhere else np.zeros(256, bool)


def _minimal(step: np.ndarray, accepts: np.ndarray, dead: int):
    """Merge states that no input tells apart; returns the start's and the dead state's new numbers too."""
    different = np.unique(step, axis=1)
    group = np.unique(accepts, return_inverse=True)[1].astype(np.int64)
    while True:
        refined = group
        for column in different.T:
            refined = np.unique(refined * len(step) + group[column], return_inverse=True)[1].astype(np.int64)
        if refined.max() == group.max():
            first = np.unique(refined, return_index=True)[1]
            return refined[step[first]], accepts[first], int(refined[0]), int(refined[dead]) if dead >= 0 else -1
        group = refined


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.all = Automaton(rules, anywhere=True, backwards=True)
        self.single = [Automaton((rule,), anywhere=False) for rule in rules]
        self.flat = self.all.step.astype(np.int32).ravel()
        del self.all.step  # sent to every task
        self.steps, self.ends = self.flat.tolist(), self.all.accepts.tolist()
        self.tables = [(a.step.tolist(), a.accepts.tolist(), a.start, a.dead) for a in self.single]
        self.value_bytes = [_byte_set(parser.parse(r.value)[0][1]) if r.value else set() for r in rules]

    def lanes(self, data: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begins and ends of lanes: cut behind a reset byte about every LANE bytes, and where a text stops."""
        resets = np.flatnonzero(self.all.resets[data]) + 1
        # Of the reset bytes, the first in each stretch of LANE bytes.
        chosen = resets[np.diff(resets // LANE, prepend=-1) > 0] if len(resets) else resets
        ends = np.unique(np.concatenate([chosen, stops]))
        ends = ends[ends > 0]
        return np.concatenate([[0], ends[:-1]]).astype(np.int64), ends.astype(np.int64)

    def flagged(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether a match begins in each lane; long lanes count as flagged and are not read."""
        seen = end - begin > LONG_LANE
        order = np.argsort(begin - end, kind="stable")  # longest first
        order = order[~seen[order]]
        for at in range(0, len(order), LANES_AT_ONCE):
            lane = order[at : at + LANES_AT_ONCE]
            place, left = end[lane] - 1, end[lane] - begin[lane]
            state = np.full(len(lane), self.all.start, np.int32)
            met = np.zeros(len(lane), np.int64)
            live_at = np.searchsorted(-left, -np.arange(1, int(left[0]) + 1), side="right") if len(left) else []
            for depth, live in enumerate(live_at):
                state = self.flat[(state[:live] << 8) + data[place[:live] - depth]]
                met[:live] |= self.all.accepts[state]
            seen[lane] = met != 0
        return seen

    def starts(self, raw: bytes) -> list[list[int]]:
        """Per rule the places in a lane, in rising order, where a match begins."""
        out: list[list[int]] = [[] for _ in self.rules]
        state, steps, ends = self.all.start, self.steps, self.ends
        place = len(raw)
        for byte in reversed(raw):
            place -= 1
            state = steps[(state << 8) + byte]
            if ends[state]:
                for rule, places in enumerate(out):
                    if ends[state] >> rule & 1:
                        places.append(place)
        for places in out:
            places.reverse()
        return out

    def matches(self, raw: bytes, rule: int, starts: list[int]) -> list[tuple[int, int]]:
        """Leftmost matches of one rule that do not overlap, each as long as possible, without those too short."""
        step, accepts, start, dead = self.tables[rule]
        least, value = self.rules[rule].least, self.value_bytes[rule]
        out, free = [], 0
        for at in starts:
            if at < free:
                continue
            state = start
            for place in range(at, len(raw)):
                state = step[state][raw[place]]
                if state == dead:
                    break
                if accepts[state]:
                    free = place + 1
            if self._value_length(raw, at, free, value) >= least:
                out.append((at, free))
        return out

    def _value_length(self, raw: bytes, begin: int, end: int, value: set[int]) -> int:
        if not value:
            return end - begin
        # The value is what is left behind the shortest prefix that the rule accepts with one value byte.
        step, accepts, start, _ = self.tables[[i for i, v in enumerate(self.value_bytes) if v is value][0]]
        state = start
        for place in range(begin, end):
            state = step[state][raw[place]]
            if accepts[state]:
                return end - place
        return 0

    def scan(self, texts: list[bytes]) -> list[list[tuple[str, int, int]]]:
        """Spans (kind, start, end) of each text in characters, by start and then in the rules' order."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        joined = b"".join(texts)
        stops = np.cumsum([len(t) for t in texts])
        if not joined:
            return [[] for _ in texts]
        data = np.frombuffer(joined, np.uint8)
        begin, end = self.lanes(data, stops)
        seen = self.flagged(data, begin, end)
        for lane in np.flatnonzero(seen).tolist():
            a, b = int(begin[lane]), int(end[lane])
            k = int(np.searchsorted(stops, a, side="right"))
            shift = a - (int(stops[k - 1]) if k else 0)
            raw = joined[a:b]
            for rule, starts in enumerate(self.starts(raw)):
                if starts:
                    out[k] += [(rule, x + shift, y + shift) for x, y in self.matches(raw, rule, starts)]
        return [self._characters(t, s) for t, s in zip(texts, out, strict=True)]

    def _characters(self, raw: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[str, int, int]]:
        if not spans:
            return []
        ascii_only = raw.isascii()
        places = sorted({p for _, a, b in spans for p in (a, b)})
        char, count, before = {}, 0, 0
        for p in places:
            count += p - before if ascii_only else len(raw[before:p].decode("utf-8", "replace"))
            char[p], before = count, p
        return [(self.rules[r].kind, char[a], char[b]) for r, a, b in sorted(spans, key=lambda s: (s[1], s[0], s[2]))]


TEXTS_BYTES = 2 << 20


MASK = "[SECRET]"


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str = MASK) -> str:
    """The text with every span, or run of overlapping spans, replaced by ``mark``."""
    parts, at = [], 0
    for _, begin, end in spans:
        if end > at:
            if begin >= at:
                parts += [text[at:begin], mark]
            at = end
    return "".join([*parts, text[at:]])


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", masked: str | None = None) -> DataFrame:
    """Add ``spans``: kind, start and end (in characters, end exclusive) of every secret of the whole text.

    ``masked`` names a column for the text with its secrets masked, if wanted.
    """

    scanner = Scanner(rules)
    fields = [T.StructField("spans", SPANS)] + ([T.StructField(masked, T.StringType())] if masked else [])

    def prepare():
        def compute(texts):
            out, waiting, size = [], [], 0
            for t in texts:
                waiting.append((t.as_py() or "").encode("utf-8", "surrogatepass"))
                size += len(waiting[-1])
                if size >= TEXTS_BYTES:
                    out += scanner.scan(waiting)
                    waiting, size = [], 0
            out += scanner.scan(waiting)
            columns = [[[{"kind": k, "start": a, "end": b} for k, a, b in spans] for spans in out]]
            if masked:
                columns.append([redacted(t.as_py(), spans) if spans else t.as_py() for t, spans in zip(texts, out, strict=True)])
            return columns

        return compute

    return append_columns(docs, [text], T.StructType(fields), prepare)
