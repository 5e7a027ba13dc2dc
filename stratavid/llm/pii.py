"""Personal data: fixed patterns, and a character BiLSTM-CRF trained on their spans that adds more."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratavid.llm.common import stored
from stratavid.llm.spans import Span, apart, span_rows
from stratavid.llm.tokens import slices

KINDS = ("email", "ip", "card", "phone")

# Documents that training windows are drawn from at most; windows of one document, and of all,
# with a span and as many without.
SAMPLE_DOCS = 20_000
WINDOWS_EACH = 4
SAMPLE_WINDOWS = 1200

# Characters of a window that is trained on, and how many go in a row; characters of one that is searched, and by how many the next one begins later.
LEARNED, JOINED = 64, 4
WIDTH, STRIDE = 256, 224
# Windows that are computed at a time.
BLOCK = 1024
HIDDEN = 8
EPOCHS = 14

# --- the fixed patterns -------------------------------------------------------------------

# The four base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TRIGGER = re.compile(r"[0-9@]")


def _emails(text: str) -> list[Span]:
    """Leftmost matches of local part, at sign and domain, found from the at signs in linear time."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = int(c) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _fits(kind: str, found: str) -> bool:
    """What a match must satisfy beyond its pattern."""
    if kind == "ip":
        return all(_small(p) for p in found.split("."))
    digits = _digits(found)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, those that fail their test left out."""
    if not _TRIGGER.search(text):
        return []
    out = _emails(text)
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if _fits(kind, m.group())]
    return out


# --- the model ----------------------------------------------------------------------------

# Letters and digits are known by their kind, other ASCII characters by themselves.
_CODE = np.full(128, 4, np.int64)
for _n, _c in enumerate(range(33, 127)):
    _CODE[_c] = 5 + _n
for _n, _group in enumerate(("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")):
    _CODE[[ord(c) for c in _group]] = _n
_CODE[[9, 10, 13, 32]] = 3
SYMBOLS = 5 + 94 + 1
PAD = SYMBOLS - 1
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _CODE[np.minimum(points, 127)], 4)


def _forbidden() -> np.ndarray:
    """Tag pairs that cannot follow each other: inside only follows its own begin or inside, begin only outside."""
    out = np.zeros((TAGS, TAGS), bool)
    out[1:, 1::2] = True
    for k in range(len(KINDS)):
        out[:, 2 + 2 * k] = True
        out[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = False
    return out


FORBIDDEN = _forbidden()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Tagger:
    """Bidirectional LSTM over character codes with a linear-chain CRF over tags, in numpy."""

    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        h = HIDDEN
        self.p: dict[str, np.ndarray] = {
            "x": draw.normal(0, 0.3, (2, SYMBOLS, 4 * h)),
            "h": draw.normal(0, 0.3, (2, h, 4 * h)),
            "c": np.tile(np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)]), (2, 1)),
            "out": draw.normal(0, 0.3, (2 * h, TAGS)),
            "bias": np.zeros(TAGS),
            "move": np.zeros((TAGS, TAGS)),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _run(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states of both directions (steps, windows, 2 * HIDDEN); ``x`` is (steps, windows).

        Both directions go in one loop, the backward one over reversed steps; padding holds the state.
        """
        h, steps, wide = HIDDEN, *x.shape
        both = np.stack([x, x[::-1]])
        into = np.stack([self.p["x"][w][both[w]] + self.p["c"][w] for w in (0, 1)])
        live = (both != PAD)[..., None]
        state, cell = np.zeros((2, 2, wide, h), np.float32)
        out = np.empty((2, steps, wide, h), np.float32)
        for t in range(steps):
            z = into[:, t] + state @ self.p["h"]
            gate, new = _sigmoid(z[..., : 3 * h]), np.tanh(z[..., 3 * h :])
            i, f, o = gate[..., :h], gate[..., h : 2 * h], gate[..., 2 * h :]
            before, last = cell, state
            cell = np.where(live[:, t], f * cell + i * new, cell)
            squashed = np.tanh(cell)
            state = np.where(live[:, t], o * squashed, state)
            out[:, t] = state
            if keep is not None:
                keep.append((i, f, o, new, before, last, squashed))
        return np.concatenate([out[0], out[1][::-1]], axis=2)

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return self._run(x) @ self.p["out"] + self.p["bias"]

    def scan(self, x: np.ndarray) -> np.ndarray:
        """Emissions like ``emissions`` where ``x`` is no padding, (windows, steps, TAGS), several times as fast.

        Windows lie along the last axis, and all steps work in place on one block of single precision. Padding closes the
        input gate, so the backward direction enters the text with an empty state; padding may only follow the text.
        """
        h, steps, wide = HIDDEN, *x.shape
        # The gates' sums are kept negative: the logistic function of x is 1 / (1 + exp(-x)).
        turned = np.repeat(np.array([-1, -1, -1, 1], np.float32), h)
        table = (self.p["x"] + self.p["c"][:, None, :]) * turned
        table = np.ascontiguousarray(table.transpose(0, 2, 1))
        turn = np.ascontiguousarray((self.p["h"] * turned).transpose(0, 2, 1))
        table[:, :h, PAD] = 1e4
        x = x.astype(np.intp)
        state, cell, new = np.zeros((3, 2, h, wide), np.float32)
        z, out = np.empty((2, 4 * h, wide), np.float32), np.empty((steps, 2 * h, wide), np.float32)
        into, gate = np.empty_like(z), z[:, : 3 * h]
        with np.errstate(over="ignore"):  # a closed gate: 1 / infinity
            for t in range(steps):
                np.matmul(turn, state, out=z)
                table[0].take(x[t], axis=1, out=into[0], mode="clip")
                table[1].take(x[steps - 1 - t], axis=1, out=into[1], mode="clip")
                z += into
                np.tanh(z[:, 3 * h :], out=new)
                np.exp(gate, out=gate)
                gate += 1
                np.reciprocal(gate, out=gate)
                new *= z[:, :h]
                cell *= z[:, h : 2 * h]
                cell += new
                np.tanh(cell, out=state)
                state *= z[:, 2 * h : 3 * h]
                out[t, :h], out[steps - 1 - t, h:] = state
        emit = self.p["out"].T @ out
        emit += self.p["bias"][:, None]
        return np.ascontiguousarray(emit.transpose(2, 0, 1))

    def _back(self, x: np.ndarray, kept: list, d_both: np.ndarray, grad: dict) -> None:
        h, steps, wide = HIDDEN, *x.shape
        both = np.stack([x, x[::-1]])
        live = (both != PAD)[..., None]
        d_out = np.stack([d_both[:, :, :h], d_both[::-1, :, h:]])
        d_state, d_cell = np.zeros((2, 2, wide, h), np.float32)
        dz, grad["h"] = np.empty((2, steps, wide, 4 * h), np.float32), np.zeros_like(self.p["h"])
        turned = self.p["h"].transpose(0, 2, 1)
        for t in range(steps - 1, -1, -1):
            i, f, o, new, before, last, squashed = kept[t]
            ds = d_state + d_out[:, t]
            own = np.where(live[:, t], ds, 0)
            dc = np.where(live[:, t], d_cell + own * o * (1 - squashed**2), 0)
            step = np.concatenate(
                [dc * new * i * (1 - i), dc * before * f * (1 - f), own * squashed * o * (1 - o), dc * i * (1 - new**2)], axis=2
            )
            dz[:, t] = step
            grad["h"] += last.transpose(0, 2, 1) @ step
            d_state = step @ turned + np.where(live[:, t], 0, ds)
            d_cell = np.where(live[:, t], dc * f, d_cell)
        grad["c"] = dz.sum(axis=(1, 2))
        grad["x"] = np.stack(
            [np.eye(SYMBOLS, dtype=np.float32)[both[w].ravel()].T @ dz[w].reshape(-1, 4 * h) for w in (0, 1)]
        )

    def gradient(self, x: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-likelihood of the tags, (steps, windows) like ``x``."""
        kept: list = []
        both = self._run(x, kept)
        emit, move = both @ self.p["out"] + self.p["bias"], np.where(FORBIDDEN, np.float32(-30), self.p["move"])
        steps, wide = x.shape
        live = x != PAD
        ahead, behind = np.empty_like(emit), np.empty_like(emit)
        ahead[0] = emit[0]
        for t in range(1, steps):
            step = _logsum(ahead[t - 1][:, :, None] + move, 1) + emit[t]
            ahead[t] = np.where(live[t][:, None], step, ahead[t - 1])
        behind[-1] = 0
        for t in range(steps - 2, -1, -1):
            step = _logsum(move + (emit[t + 1] + behind[t + 1])[:, None, :], 2)
            behind[t] = np.where(live[t + 1][:, None], step, behind[t + 1])
        total = _logsum(ahead[-1], 1)
        share = np.exp(np.minimum(ahead + behind - total[None, :, None], 0)) * live[:, :, None]
        d_emit = (share - np.eye(TAGS, dtype=np.float32)[tags] * live[:, :, None]) / wide
        pair = ahead[:-1, :, :, None] + move + (emit + behind)[1:, :, None, :] - total[None, :, None, None]
        d_move = (np.exp(np.minimum(pair, 0)) * live[1:, :, None, None]).sum(axis=(0, 1))
        seen = (tags[:-1] * TAGS + tags[1:])[live[1:]]
        d_move -= np.bincount(seen, minlength=TAGS * TAGS).reshape(TAGS, TAGS)
        grad = {"move": np.where(FORBIDDEN, 0, d_move / wide), "bias": d_emit.sum(axis=(0, 1))}
        grad["out"] = both.reshape(-1, 2 * HIDDEN).T @ d_emit.reshape(-1, TAGS)
        self._back(x, kept, d_emit @ self.p["out"].T, grad)
        return grad

    def fit(self, x: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, batch: int = 24, rate: float = 0.03) -> Tagger:
        """Adam over shuffled windows with a fixed seed; ``x`` and ``tags`` are (windows, steps)."""
        draw = np.random.default_rng(3)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, last = 0, max(1, epochs * -(-len(x) // batch))
        for _ in range(epochs):
            order = draw.permutation(len(x))
            for lo in range(0, len(x), batch):
                some = order[lo : lo + batch]
                grad = self.gradient(x[some].T, tags[some].T)
                norm = np.sqrt(sum((g**2).sum() for g in grad.values()))
                step += 1
                for k, g in grad.items():
                    g = g / max(1.0, norm / 5)
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    square[k] = 0.99 * square[k] + 0.01 * g**2
                    size = rate * (1 - 0.9 * step / last)
                    self.p[k] -= size * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def moves(self) -> np.ndarray:
        """Transition scores; what is forbidden costs more than anything can gain."""
        return np.where(FORBIDDEN, -1e4, self.p["move"])

    def within(self, emit: np.ndarray) -> np.ndarray:
        """Characters of a text that may lie in a span of its best path.

        A span of a path can always be put outside instead. What it gains over that is the sum of what its begin, its
        inner characters and its end gain on their own; where no begin before and no end behind a character
        gain anything together, no best path has a span there.
        """
        move, out = self.moves(), np.zeros(len(emit), bool)
        for b in range(1, TAGS, 2):
            stay = max(move[b, b + 1], move[b + 1, b + 1]) - move[0, 0]
            own, start = emit[:, b + 1] - emit[:, 0] + np.float32(stay), emit[:, b] - emit[:, 0]
            # Without a sum: the best begin, all that inner characters can gain, the best end.
            most = start.max(initial=-np.inf) + np.maximum(own, 0).sum(dtype=float) + max(0, move[0, b] - move[0, 0])
            if most + max(0, max(move[b, 0], move[b + 1, 0]) - move[0, 0]) < -1:
                continue
            inner = np.cumsum(own, dtype=float)
            begin = start + move[0, b] - move[0, 0] - inner
            end = inner + max(move[b, 0], move[b + 1, 0]) - move[0, 0]
            begin[:1] -= move[0, b] - move[0, 0]  # nothing is before the text, nothing behind it
            end[-1:] = inner[-1:]
            out |= np.maximum.accumulate(begin) + np.maximum.accumulate(end[::-1])[::-1] > -1e-3
        return out

    def decode(self, emit: list[np.ndarray], ends: list[tuple[bool, bool]] | None = None) -> list[np.ndarray]:
        """Best tag path of each stretch (steps, TAGS); stretches of similar length go together.

        ``ends`` tells of each stretch whether the text goes on, outside of any span, before and after it.
        """
        move = self.moves()
        ends = ends or [(False, False)] * len(emit)
        out: list = [None] * len(emit)
        order = sorted(range(len(emit)), key=lambda n: len(emit[n]))
        for lo in range(0, len(order), 256):
            some = order[lo : lo + 256]
            size = np.array([len(emit[n]) for n in some])
            steps = int(size.max())
            score = np.zeros((steps, len(some), TAGS))
            for w, n in enumerate(some):
                score[: size[w], w] = emit[n]
            before, after = (np.array([[ends[n][side]] for n in some]) for side in (0, 1))
            best = score[0] + np.where(before, move[0], 0)
            best[:, 2::2] -= 1e4  # no stretch begins inside a span
            back = np.zeros((steps, len(some), TAGS), np.int8)
            for t in range(1, steps):
                way = best[:, :, None] + move
                back[t] = way.argmax(axis=1)
                new = way.max(axis=1) + score[t]
                best = np.where((t < size)[:, None], new, best)
            tag = (best + np.where(after, move[:, 0], 0)).argmax(axis=1)
            path = np.zeros((steps, len(some)), np.int64)
            for t in range(steps - 1, -1, -1):
                inside = t < size
                path[t] = np.where(inside, tag, 0)
                if t:
                    tag = np.where(inside, back[t][np.arange(len(some)), tag], tag)
            for w, n in enumerate(some):
                out[n] = path[: size[w], w]
        return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


# Weight of the later of two overlapping windows by place: windows know least about their ends.
_FADE = (np.arange(1, WIDTH - STRIDE + 1, dtype=np.float32) / (WIDTH - STRIDE + 1))[:, None]


def _emitted(tagger: Tagger, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """Averaged emissions of all characters of all texts, block by block: first place, (places, TAGS).

    Places count on over the texts as ``_laid_out`` puts them. Overlapping windows cover every text. Where two
    overlap, their emissions are averaged, the more the nearer to a window's middle.
    """
    first, size = _laid_out(texts)
    coded = np.full(size, PAD, np.int8)
    for at, text in zip(first, texts):
        coded[at : at + len(text)] = codes(text)
    starts = np.concatenate([np.arange(a, b - WIDTH + 1, STRIDE) for a, b in zip(first, [*first[1:], size])] or [np.zeros(0, int)])
    rest, head = WIDTH - STRIDE, np.arange(WIDTH)
    carried = None
    for lo in range(0, len(starts), BLOCK):
        some = starts[lo : lo + BLOCK]
        scores = tagger.scan(coded[some[None, :] + head[:, None]])
        begin, end = some[0], some[-1] + STRIDE
        # The earlier windows that overlap with their next one, the last one of the block before included.
        over = np.flatnonzero(np.diff(some) == STRIDE)
        scores[over + 1, :rest] = scores[over + 1, :rest] * _FADE + scores[over, STRIDE:] * (1 - _FADE)
        if carried is not None:
            scores[0, :rest] = scores[0, :rest] * _FADE + carried * (1 - _FADE)
        more = lo + BLOCK < len(starts) and starts[lo + BLOCK] == end
        carried = scores[-1, STRIDE:].copy() if more else None
        emit = np.empty((end + rest - begin, TAGS), np.float32)
        for at, own in zip((some - begin).tolist(), scores):
            emit[at : at + WIDTH] = own  # what two windows share is in the later one
        yield begin, emit[: len(emit) - rest] if more else emit


def _laid_out(texts: list[str]) -> tuple[list[int], int]:
    """First place of each text, and the number of places: each text is rounded up to whole windows."""
    first, size = [], 0
    for text in texts:
        first.append(size)
        size += max(1, -(-(len(text) - WIDTH + STRIDE) // STRIDE)) * STRIDE + WIDTH - STRIDE
    return first, size


def tag_texts(tagger: Tagger, texts: list[str]) -> list[list[Span]]:
    """Spans the model finds in each text: those of the best path over the whole text.

    All characters go through the model. Most cannot lie in a span of the best path (``Tagger.within``); paths
    are decoded between those, which gives the path of the whole text.
    """
    first, size = _laid_out(texts)
    emit = np.empty((size, TAGS), np.float32)
    for begin, own in _emitted(tagger, texts):
        emit[begin : begin + len(own)] = own
    parts: list[tuple[int, int, int]] = []
    for n, text in enumerate(texts):
        inside = tagger.within(emit[first[n] : first[n] + len(text)])
        edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
        parts += [(n, a, b) for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())]
    held = [emit[first[n] + a : first[n] + b] for n, a, b in parts]
    paths = tagger.decode(held, [(a > 0, b < len(texts[n])) for n, a, b in parts])
    out: list[list[Span]] = [[] for _ in texts]
    for (n, lo, _), path in zip(parts, paths):
        begins = np.flatnonzero((path % 2 == 1))
        for b in begins.tolist():
            e = b + 1
            while e < len(path) and path[e] == path[b] + 1:
                e += 1
            out[n].append((KINDS[(path[b] - 1) // 2], lo + b, lo + e))
    return out


def _plausible(kind: str, found: str) -> bool:
    """A span the model adds must hold what its kind cannot do without."""
    if kind == "email":
        name, _, host = found.partition("@")
        return "." in host and any(c.isalnum() for c in name) and len(host) > 3
    if kind == "ip":
        parts = re.split(r"[^0-9]+", found.strip())
        return len(parts) == 4 and all(p and _small(p) for p in parts)
    return _fits(kind, found)


def find(tagger: Tagger | None, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text: the model adds what overlaps no base span."""
    base = [base_spans(t) for t in texts]
    more = tag_texts(tagger, texts) if tagger else [[] for _ in texts]
    out = []
    for text, own, found in zip(texts, base, more):
        good = [(k, s, e) for k, s, e in found if _plausible(k, text[s:e])]
        out.append((own, own + apart(good, own)))
    return out


# --- training -----------------------------------------------------------------------------


def training_windows(text: str, draw: random.Random) -> list[tuple[str, list[Span]]]:
    """Windows of a text with the base spans inside, and windows in which a span stands in other words of the text.

    Some spans are rewritten in ways people write them, so that the model learns forms and not only what
    stands around them. Of a text of many spans or triggers some are drawn.
    """
    spans = base_spans(text)
    triggers = [m.start() for m in _TRIGGER.finditer(text)]
    some = draw.sample(spans, min(len(spans), WINDOWS_EACH))
    starts = [max(0, e - draw.randint(e - s, LEARNED)) for _, s, e in some if e - s <= LEARNED]
    starts += [max(0, at - draw.randrange(LEARNED)) for at in draw.sample(triggers, min(len(triggers), WINDOWS_EACH))]
    starts += [draw.randrange(max(1, len(text))) for _ in range(2)]
    words = [w for w in dict.fromkeys(text.split(" ")) if w.isascii() and w.isalpha()][:200] or ["name"]
    out = []
    for lo in starts:
        hi = lo + LEARNED
        if any(s < hi and e > lo and not (s >= lo and e <= hi) for _, s, e in spans):
            continue  # a span cut in two teaches nothing
        out.append((text[lo:hi], [(k, s - lo, e - lo) for k, s, e in spans if s >= lo and e <= hi]))
    for kind, s, e in some + some:
        new = _rewritten(kind, text[s:e], draw, words) if draw.random() < 0.7 else text[s:e]
        at = draw.randrange(max(1, len(text)))
        around = text[at : at + LEARNED - len(new) - 2]
        if len(new) + 2 > LEARNED or _TRIGGER.search(around):
            continue
        if draw.random() < 0.3:
            around = around[: draw.randint(0, len(around))]
        parts = around.split(" ")
        cut = draw.randint(0, len(parts))
        front = " ".join(parts[:cut]) + " " * (cut > 0)
        piece = front + new + (draw.choice([" ", " ", ", ", ". "]) + " ".join(parts[cut:]) if cut < len(parts) else "")
        out.append((piece[:LEARNED], [(kind, len(front), len(front) + len(new))]))
    # A number is no card only by its check digit, which the model need not learn.
    return [w for w in out if not any(12 <= len(d) <= 19 and not luhn(d) for d in (_digits(m.group()) for m in _CARD.finditer(w[0])))]


def _rewritten(kind: str, found: str, draw: random.Random, words: list[str]) -> str:
    """A span in another form; names and hosts are also made of ``words``."""
    if kind == "phone":
        found = found.lstrip("+") if draw.random() < 0.5 else found
        return re.sub(r"[ ().-]+", draw.choice([" ", "-"]), found)
    if kind == "email":
        name, _, host = found.partition("@")
        first, second = (draw.choice(words) for _ in range(2))
        name = draw.choice([name, first, f"{first}.{second}", f"{first}_{second}.{name}"])
        host = draw.choice([host, f"{second}.{host.rpartition('.')[2]}", f"{first}-{second}-{host}", f"mail.{host}"])
        return name + draw.choice([" @ ", " @", "@ ", " @ "]) + host
    if kind == "card":
        return "/".join(re.findall("....?", _digits(found)))
    return found.replace(".", draw.choice([" . ", ". "]))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Tagger | None:
    """A tagger from windows of at most SAMPLE_DOCS documents, the first by a hash of their id.

    Labels are the base spans in the windows. Only windows reach the driver, SAMPLE_WINDOWS with a span and as many
    without at most.
    Without a labelled window there is no model, and the base spans stand alone.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL")
    chosen = rows.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = []
                for doc_id, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    draw = random.Random(doc_id)
                    windows = training_windows(text or "", draw)
                    draw.shuffle(windows)
                    for labelled in (True, False):
                        chosen = [w for w in windows if bool(w[1]) == labelled][:WINDOWS_EACH]
                        found += [(doc_id, piece, repr(spans)) for piece, spans in chosen]
                columns = list(zip(*found)) or [[], [], []]
                kinds = [pa.int64(), pa.string(), pa.string()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "piece", "spans"])

    windows = rows.join(F.broadcast(chosen), "id").mapInArrow(run, "id long, piece string, spans string")  # SAMPLE_DOCS ids
    windows = stored(windows, "pii-windows")
    some = []
    for labelled in (F.col("spans") != "[]", F.col("spans") == "[]"):
        some += windows.where(labelled).orderBy(F.xxhash64("id", "piece"), "piece", "spans").limit(SAMPLE_WINDOWS).collect()
    return fit_windows([(r["piece"], _read(r["spans"])) for r in some])


def _read(spans: str) -> list[Span]:
    return [(k, int(s), int(e)) for k, s, e in re.findall(r"\('(\w+)', (\d+), (\d+)\)", spans)]


def fit_windows(windows: list[tuple[str, list[Span]]]) -> Tagger | None:
    """A tagger from windows and their spans; JOINED of them make a row, as searched windows are that long."""
    if not any(spans for _, spans in windows):
        return None
    mixed = random.Random(4).sample(windows, len(windows))
    rows = [mixed[n : n + JOINED] for n in range(0, len(mixed), JOINED)]
    x, tags = np.full((len(rows), JOINED * (LEARNED + 1)), PAD), np.zeros((len(rows), JOINED * (LEARNED + 1)), np.int64)
    for n, row in enumerate(rows):
        at = 0
        for piece, spans in row:
            own = codes(piece + " ")
            x[n, at : at + len(own)] = own
            for kind, s, e in sorted(spans, key=lambda s: -KINDS.index(s[0])):
                tag = 1 + 2 * KINDS.index(kind)
                tags[n, at + s : at + e] = tag + 1
                tags[n, at + s] = tag
            at += len(own)
    legal = ~FORBIDDEN[tags[:, :-1], tags[:, 1:]].any(axis=1)
    return Tagger().fit(x[legal], tags[legal])


def find_personal_data(docs: DataFrame, tagger: Tagger | None, **columns) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    One pass over whole texts without a shuffle; memory is bounded by a slice of texts. A null text
    is empty; a null id stays null; repeated rows get equal results; empty tables give empty
    results; further columns are ignored.
    """
    return span_rows(docs, KINDS, lambda texts: find(tagger, texts), **columns)
