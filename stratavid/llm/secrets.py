"""Secrets: fixed patterns, and probabilistic automata inferred from their matches that add more."""

from __future__ import annotations

import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratavid.llm.spans import Span, apart, span_rows
from stratavid.llm.tokens import slices

KINDS = ("assign", "access", "hex")

# Documents that examples are drawn from at most, and examples of each kind and of plain candidates.
SAMPLE_DOCS = 20_000
EXAMPLES = 300
PLAIN_EACH, PLAIN = 2, 1500
# Share of a kind's credentials that may lie below what counts as its format, and rounds of sorting
# bare credentials out of the plain examples.
FLOOR = 0.02
ROUNDS = 5
# Confidence of the test that keeps two states apart.
ALPHA = 0.01
# A candidate is a run of so many credential characters at least.
LEAST = 12

# --- the fixed patterns -------------------------------------------------------------------

# The three base patterns.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # whole runs: a shorter run cannot match


def base_matches(text: str) -> list[tuple[str, int, int, str]]:
    """Kind, start, end and credential of each kind's leftmost matches; those too short are left out."""
    out = [("assign", m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    out += [("hex", m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    return out


# --- automata -----------------------------------------------------------------------------

# Symbols: digits, hex letters, other letters by case; punctuation marks by themselves.
_GROUPS = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+", "/", "_", ".", "=", "-")
SYMBOLS = len(_GROUPS)
_SYMBOL = np.full(256, -1, np.int64)
for _n, _group in enumerate(_GROUPS):
    _SYMBOL[[ord(c) for c in _group]] = _n
# Log-likelihood of a symbol that a state has not seen.
UNSEEN = math.log(1e-3)


@dataclass
class Automaton:
    """States with the next state and the log-probability of each symbol, and of an end there."""

    step: np.ndarray
    log_p: np.ndarray
    log_end: np.ndarray

    def likelihood(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Mean log-probability per symbol of many runs of ``symbols``."""
        total, state = np.zeros(len(starts)), np.zeros(len(starts), np.int64)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        live, t = len(starts), 0
        while live > 8:
            live = int(np.searchsorted(-lengths, -t, side="left"))
            if live <= 8:
                break
            s = symbols[starts[:live] + t]
            total[:live] += self.log_p[state[:live], s]
            state[:live] = self.step[state[:live], s]
            t += 1
        step, log_p = self.step.tolist(), self.log_p.tolist()
        for n in range(live):  # the few longest runs, on their own
            q, sum_ = int(state[n]), 0.0
            for s in symbols[starts[n] + t : starts[n] + lengths[n]].tolist():
                sum_ += log_p[q][s]
                q = step[q][s]
            state[n] = q
            total[n] += sum_
        out = np.empty(len(starts))
        out[order] = (total + self.log_end[state]) / (lengths + 1)
        return out


def infer(examples: list[str], alpha: float = ALPHA) -> Automaton:
    """A probabilistic automaton from examples: a prefix tree whose compatible states are merged.

    States are visited breadth first. A state is merged into the first settled state whose end and
    symbol frequencies, and those of all states behind, differ by no more than a Hoeffding bound
    allows; else it is settled itself. A symbol that a state has not seen costs UNSEEN and leads where the
    symbol leads most often in the automaton, so that one surprise does not spoil the rest of a run.
    """
    next_: list[dict[int, int]] = [{}]
    seen: list[dict[int, int]] = [{}]
    end, total = [0], [0]
    for text in sorted(examples):
        at = 0
        for c in text:
            symbol = int(_SYMBOL[ord(c)])
            total[at] += 1
            if symbol not in next_[at]:
                next_[at][symbol] = len(next_)
                next_.append({})
                seen.append({})
                end.append(0)
                total.append(0)
            seen[at][symbol] = seen[at].get(symbol, 0) + 1
            at = next_[at][symbol]
        total[at] += 1
        end[at] += 1
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(f1: int, n1: int, f2: int, n2: int) -> bool:
        return n1 > 0 and n2 > 0 and abs(f1 / n1 - f2 / n2) > bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def compatible(one: int, other: int) -> bool:
        todo = [(one, other)]
        while todo:
            a, b = todo.pop()
            if differ(end[a], total[a], end[b], total[b]):
                return False
            for s in seen[a].keys() | seen[b].keys():
                if differ(seen[a].get(s, 0), total[a], seen[b].get(s, 0), total[b]):
                    return False
                if s in next_[a] and s in next_[b]:
                    todo.append((next_[a][s], next_[b][s]))
        return True

    def fold(one: int, other: int) -> list[tuple[int, int]]:
        """Adds the counts of ``other`` and all behind; the transitions that this gave to other states."""
        todo, given = [(one, other)], []
        while todo:
            a, b = todo.pop()
            end[a] += end[b]
            total[a] += total[b]
            for s, count in seen[b].items():
                seen[a][s] = seen[a].get(s, 0) + count
                if s in next_[a]:
                    todo.append((next_[a][s], next_[b][s]))
                else:
                    next_[a][s] = next_[b][s]
                    given.append((a, s))
        return given

    settled, waiting = [0], deque((0, s) for s in sorted(next_[0]))
    known = {0}
    while waiting:
        parent, s = waiting.popleft()
        state = next_[parent][s]
        if state in known:
            continue
        for old in settled:
            if compatible(old, state):
                next_[parent][s] = old
                waiting.extend((a, x) for a, x in sorted(fold(old, state)) if a in known)
                break
        else:
            settled.append(state)
            known.add(state)
            waiting.extend((state, x) for x in sorted(next_[state]))
    number = {state: n for n, state in enumerate(settled)}
    lost = len(settled)  # where symbols that no state has seen lead, and stay
    ways: dict[int, Counter] = {}
    for state in settled:
        for s, count in seen[state].items():
            ways.setdefault(s, Counter())[number[next_[state][s]]] += count
    usual = np.full(SYMBOLS, lost, np.int64)
    for s, to in ways.items():
        usual[s] = min(to, key=lambda n: (-to[n], n))
    step = np.tile(usual, (lost + 1, 1))
    step[lost] = lost
    log_p = np.full((lost + 1, SYMBOLS), UNSEEN)
    log_end = np.full(lost + 1, UNSEEN)
    for state, n in number.items():
        for s, count in seen[state].items():
            step[n, s] = number[next_[state][s]]
            log_p[n, s] = max(UNSEEN, math.log(count / total[state]))
        log_end[n] = max(UNSEEN, math.log(max(end[state], 1e-9) / max(total[state], 1)))
    return Automaton(step, log_p, log_end)


@dataclass
class Grammar:
    """An automaton for each kind with the least likelihood its format has, and one for plain candidates."""

    kinds: dict[str, Automaton]
    floors: dict[str, float]
    plain: Automaton

    def score(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best excess over the plain automaton, and the number of the kind that has it.

        Only kinds whose format a run has count; without any the excess is minus infinity.
        """
        own = np.stack([a.likelihood(symbols, starts, lengths) for a in self.kinds.values()])
        own[own < np.array([[self.floors[k]] for k in self.kinds])] = -math.inf
        return own.max(axis=0) - self.plain.likelihood(symbols, starts, lengths), own.argmax(axis=0)


def runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of the bytes, and start and length of every candidate: runs of LEAST symbols or more."""
    symbols = _SYMBOL[data]
    edge = np.diff(np.concatenate([[0], (symbols >= 0).astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = ends - starts >= LEAST
    return symbols, starts[long], (ends - starts)[long]


def find(grammar: Grammar | None, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text: every candidate is scored, those in base spans excepted."""
    base = [[m[:3] for m in base_matches(t)] for t in texts]
    if grammar is None:
        return [(b, list(b)) for b in base]
    raw = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])  # a line end keeps texts apart
    symbols, starts, lengths = runs(np.frombuffer(b"\n".join(raw) + b"\n", np.uint8))
    more: list[list[Span]] = [[] for _ in texts]
    if len(starts):
        excess, kind = grammar.score(symbols, starts, lengths)
        names = list(grammar.kinds)
        for n in np.flatnonzero(excess > 0).tolist():
            text = int(np.searchsorted(at, starts[n], side="right")) - 1
            start = len(raw[text][: starts[n] - at[text]].decode())
            more[text].append((names[kind[n]], start, start + int(lengths[n])))
    return [(own, own + apart(found, own)) for own, found in zip(base, more)]


# --- training -----------------------------------------------------------------------------


def examples(text: str) -> list[tuple[str, str]]:
    """Labelled credentials of the text by kind, and up to PLAIN_EACH candidates without a label."""
    found = base_matches(text)
    out = [(kind, credential) for kind, _, _, credential in found]
    raw = text.encode()
    _, starts, lengths = runs(np.frombuffer(raw, np.uint8))
    plain = []
    for s, k in zip(starts.tolist(), lengths.tolist()):
        piece = raw[s : s + k].decode()
        if not any(credential in piece for _, _, _, credential in found):
            plain.append(piece)
    plain.sort(key=lambda p: (p.isalpha(), p))  # the odd ones teach most
    return out + [("plain", p) for p in plain[:PLAIN_EACH]]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Grammar | None:
    """Automata from at most SAMPLE_DOCS documents, the first by a hash of their id.

    They are read once. EXAMPLES credentials of a kind and PLAIN other candidates reach the driver at most.
    Without credentials there is no grammar, and the base spans stand alone.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL")
    chosen = rows.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [x for t in part.column("text").to_pylist() for x in examples(t or "")]
                kinds, pieces = zip(*found) if found else ([], [])
                yield pa.record_batch([pa.array(kinds, pa.string()), pa.array(pieces, pa.string())], ["kind", "piece"])

    found = rows.join(F.broadcast(chosen), "id").mapInArrow(run, "kind string, piece string").distinct()  # SAMPLE_DOCS ids
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64("piece"), "piece"))
    most = F.when(F.col("kind") == "plain", PLAIN).otherwise(EXAMPLES)
    first = found.withColumn("place", place).where(F.col("place") <= max(PLAIN, EXAMPLES)).where(F.col("place") <= most)
    picked: dict[str, list[str]] = {}
    for r in first.orderBy("kind", "place").collect():
        picked.setdefault(r["kind"], []).append(r["piece"])
    return fit(picked)


def _laid(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all pieces, and start and length of each."""
    lengths = np.array([len(p) for p in pieces], np.int64)
    return _SYMBOL[np.frombuffer("\n".join(pieces).encode(), np.uint8)], np.cumsum(lengths + 1) - lengths - 1, lengths


def fit(picked: dict[str, list[str]]) -> Grammar | None:
    """The automata. A secret has a kind's format and is likelier as that kind than as plain text.

    A run has the format of a kind if all but the least likely FLOOR of its labelled credentials are no
    likelier. Plain examples only lack a label, so those that would be secrets themselves are taken out
    and the plain automaton is inferred anew, until none is left or ROUNDS are over.
    """
    kinds = {k: infer(picked[k]) for k in KINDS if len(picked.get(k, [])) >= 5}
    if not kinds:
        return None
    floors = {k: float(np.quantile(a.likelihood(*_laid(picked[k])), FLOOR)) for k, a in kinds.items()}
    plain = picked.get("plain", [])
    grammar = Grammar(kinds, floors, infer(plain or ["plainwords"]))
    for _ in range(ROUNDS):
        bare = grammar.score(*_laid(plain))[0] > 0 if plain else np.zeros(0, bool)
        if not bare.any():
            break
        plain = [p for p, out in zip(plain, bare) if not out]
        grammar.plain = infer(plain or ["plainwords"])
    return grammar


def find_secrets(docs: DataFrame, grammar: Grammar | None, **columns) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    One pass over whole texts without a shuffle; memory is bounded by a slice of texts. A null text
    is empty; a null id stays null; repeated rows get equal results; empty tables give empty
    results; further columns are ignored.
    """
    return span_rows(docs, KINDS, lambda texts: find(grammar, texts), **columns)
