"""Personal data: base patterns, and a character-level bidirectional LSTM with CRF transitions that adds spans.

The tagger is written in numpy and learns from labelled spans: windows of the corpus with the spans of the base patterns, and
windows of it into which plain, disguised and misleading values were put (``pii_examples``). Texts are read whole, in
windows of ``WINDOW`` characters that overlap by half. Each window is decoded with the CRF's best path; the spans of all
windows of a text are then reconciled: pieces of one kind that overlap and were cut by a window's edge become one, and of
all spans the non-overlapping set with the highest total score is taken. Every window is learnt from and decoded, whatever it
holds; an added span must hold what its kind must (``holds``).

The spans of the base patterns are always kept; spans of the tagger that touch one of them are not added.

Defined results: null and empty texts have no spans; offsets are code points, end exclusive; repeated rows give equal
spans; a corpus without any text gets no tagger, and nothing is added; an empty table gives no row; other columns stay. Documents are worked on where they are; the model is a few small matrices, learnt from at
most ``MAX_WINDOWS`` windows with spans, half as many without and ``MADE`` made ones.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.llm import pii_examples
from gleaner.llm.common import map_batches
from gleaner.operators.sampling import first_by
from gleaner.session import materialise

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
WINDOW = 80
STEP = WINDOW // 2
HIDDEN = 16
#: Windows that training takes at most: this many with spans, and half as many without.
MAX_WINDOWS = 1600
#: Training steps of ``BATCH`` windows each, however many windows there are.
STEPS = 1200
BATCH = 48
RATE = 0.02
#: Mean log of the marginal probabilities of a span's tags from which on it is added.
SURE = float(np.log(0.97))
#: Windows that are decoded side by side: their states stay in the cache.
CHUNK = 768
#: Made examples that training adds to the windows of the corpus.
MADE = 2400

Span = tuple[int, int, int]

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_BASE_TRIGGER = re.compile(r"[0-9@]")
_SAID_AT = re.compile(r" *(?:[\[(] *(?:at|AT|@) *[\])]|\b(?:at|AT)\b|@) *")
_SAID_DOT = re.compile(r" *(?:[\[(] *(?:dot|DOT|\.) *[\])]|\b(?:dot|DOT)\b|\.) *")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBER = re.compile("[0-9]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # The local part runs back from the @; a run without a valid domain fails from each of its characters.
    last = 0
    for match in _DOMAIN.finditer(text):
        at = start = match.start()
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at:
            last = match.end()
            yield start, last


def _luhn(digits: str) -> bool:
    doubled = "0246813579"
    return sum(int(doubled[int(d)]) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text: str | None) -> list[Span]:
    """(kind, start, end) of the base patterns, by kind and start."""
    if not text or not _BASE_TRIGGER.search(text):
        return []
    found = [(0, *span) for span in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append((3, *m.span()))
    return found


def holds(kind: int, body: str) -> bool:
    """Whether a span holds what its kind must hold, however it is written: an address, four parts, a valid card, 8 to 15 digits after + or 00."""
    numbers = _NUMBER.findall(body)
    digits = "".join(numbers)
    if kind == 0:
        return bool(_ADDRESS.fullmatch(_SAID_DOT.sub(".", _SAID_AT.sub("@", body))))
    if kind == 1:
        return len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers)
    if kind == 2:
        return 16 <= len(digits) <= 19 and _luhn(digits)
    return 8 <= len(digits) <= 15 and body.startswith(("+", "00", "(+", "(00"))


# --- the tagger ---

_CODES = 128
_OTHER_LETTER, _OTHER = 1, 2


def codes(text: str) -> np.ndarray:
    """Character codes below 128: ASCII as it is, other letters as one, everything else as one."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where(points < _CODES, points, _OTHER).astype(np.uint8)
    high = np.flatnonzero(points >= _CODES)
    if len(high):
        kinds, which = np.unique(points[high], return_inverse=True)
        out[high] = np.array([_OTHER_LETTER if chr(p).isalpha() else _OTHER for p in kinds], np.uint8)[which]
    return out


@dataclass
class Tagger:
    """Parameters: input and recurrent weights of both directions, output weights, CRF transitions."""

    wx: list[np.ndarray]
    wh: list[np.ndarray]
    wo: np.ndarray
    bo: np.ndarray
    moves: np.ndarray

    @classmethod
    def new(cls, hidden: int = HIDDEN, seed: int = 7) -> Tagger:
        rng = np.random.default_rng(seed)
        small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        wx = [small(_CODES, 4 * hidden), small(_CODES, 4 * hidden)]
        for w in wx:
            w[:, hidden : 2 * hidden] += 1  # remember at first
        moves = np.zeros((TAGS, TAGS), np.float32)
        for kind in range(len(KINDS)):
            inside = 2 + 2 * kind
            moves[:, inside] = -4
            moves[[inside - 1, inside], inside] = 0
        return cls(wx, [small(hidden, 4 * hidden), small(hidden, 4 * hidden)], small(2 * hidden, TAGS), np.zeros(TAGS, np.float32), moves)

    def parameters(self) -> list[np.ndarray]:
        return [*self.wx, *self.wh, self.wo, self.bo, self.moves]


def _gate(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x: np.ndarray, mask: np.ndarray, wx: np.ndarray, wh: np.ndarray, trace: list | None) -> np.ndarray:
    """Hidden states (length, rows, hidden); masked places keep the state at zero."""
    rows, length = x.shape
    hidden = wh.shape[0]
    h = np.zeros((rows, hidden), np.float32)
    c = np.zeros_like(h)
    out = np.empty((length, rows, hidden), np.float32)
    for t in range(length):
        z = wx[x[:, t]] + h @ wh
        s = _gate(z[:, : 2 * hidden])
        i, f = s[:, :hidden], s[:, hidden:]
        o, g = _gate(z[:, 2 * hidden : 3 * hidden]), np.tanh(z[:, 3 * hidden :])
        m = mask[:, t, None]
        old_c, old_h = c, h
        c = (f * c + i * g) * m
        tc = np.tanh(c)
        h = o * tc * m
        out[t] = h
        if trace is not None:
            trace.append((i, f, o, g, old_c, tc, old_h, m))
    return out


def _lstm_back(x: np.ndarray, wx: np.ndarray, wh: np.ndarray, trace: list, dout: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input and recurrent weights."""
    dwx, dwh = np.zeros_like(wx), np.zeros_like(wh)
    dh = np.zeros_like(dout[0])
    dc = np.zeros_like(dh)
    every = np.empty((len(trace), *x.shape[:1], wx.shape[1]), wx.dtype)
    for t in range(len(trace) - 1, -1, -1):
        i, f, o, g, old_c, tc, old_h, m = trace[t]
        dh = (dh + dout[t]) * m
        dc = (dc + dh * o * (1 - tc**2)) * m
        dz = np.concatenate([dc * g * i * (1 - i), dc * old_c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g**2)], axis=1)
        every[t] = dz
        dwh += old_h.T @ dz
        dh = dz @ wh.T
        dc = dc * f
    # Sum the gradients of equal characters: sort the places by character and add up each run.
    seen = x.T.ravel()
    order = np.argsort(seen, kind="stable")
    runs = np.flatnonzero(np.diff(seen[order], prepend=256))
    dwx[seen[order][runs]] = np.add.reduceat(every.reshape(len(seen), -1)[order], runs, axis=0)
    return dwx, dwh


def emissions(model: Tagger, x: np.ndarray, mask: np.ndarray, traces: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Tag scores (length, rows, tags) and the states they come from."""
    ahead = _lstm(x, mask, model.wx[0], model.wh[0], traces[0] if traces else None)
    back = _lstm(x[:, ::-1], mask[:, ::-1], model.wx[1], model.wh[1], traces[1] if traces else None)[::-1]
    states = np.concatenate([ahead, back], axis=2)
    return states @ model.wo + model.bo, states


def tag_scores(model: Tagger, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The scores of :func:`emissions` as (length, tags, rows), in a third of the time.

    Both directions go side by side. A sigmoid is a tanh of half the value, so one tanh makes all gates; it also lays each gate
    out on its own.
    """
    rows, length = x.shape
    hidden, kind = model.wh[0].shape[0], model.wx[0].dtype
    half = np.where(np.arange(4 * hidden) < 3 * hidden, 0.5, 1).astype(kind)
    wx, wh, wo = [w * half for w in model.wx], [w * half / 2 for w in model.wh], model.wo / 2  # states are twice as large, too
    places = np.ascontiguousarray(x.T, np.intp)
    on = None if mask.all() else mask.T[:, :, None]
    states = np.empty((length, 2, rows, hidden), kind)
    h, c, tanh_c = (np.zeros((2, rows, hidden), kind) for _ in range(3))
    z, given, gates = np.empty((2, rows, 4 * hidden), kind), np.empty((rows, 4 * hidden), kind), np.empty((4, 2, rows, hidden), kind)
    apart, sigmoids = z.reshape(2, rows, 4, hidden).transpose(2, 0, 1, 3), gates[:3]
    i, f, o, g = gates  # the first three are twice as large
    for t in range(length):
        for way, at in enumerate((t, length - 1 - t)):
            np.matmul(h[way], wh[way], out=z[way])
            np.take(wx[way], places[at], axis=0, out=given, mode="clip")
            z[way] += given
        np.tanh(apart, out=gates)
        sigmoids += 1
        c *= f
        i *= g
        c += i
        c *= 0.5
        if on is not None:
            c[0] *= on[t]
            c[1] *= on[length - 1 - t]
        np.tanh(c, out=tanh_c)
        h = states[t]
        np.multiply(o, tanh_c, out=h)
    ahead, back = (np.ascontiguousarray(w.T) for w in (wo[:hidden], wo[hidden:]))
    scores = np.matmul(ahead, states[:, 0].transpose(0, 2, 1))
    scores += np.matmul(back, states[::-1, 1].transpose(0, 2, 1))
    scores += model.bo[:, None]
    return scores


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def sums(model: Tagger, scores: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-sums over all paths up to and after each place (length, rows, tags), and over all whole paths (rows)."""
    length = len(scores)
    on = mask.T[:, :, None] > 0
    moves, ahead = np.exp(model.moves), np.zeros_like(scores)
    forward = np.empty_like(scores)
    forward[0] = scores[0]
    for t in range(1, length):
        top = forward[t - 1].max(axis=1, keepdims=True)
        forward[t] = np.where(on[t], np.log(np.exp(forward[t - 1] - top) @ moves) + top + scores[t], forward[t - 1])
    for t in range(length - 2, -1, -1):
        after = scores[t + 1] + ahead[t + 1]
        top = after.max(axis=1, keepdims=True)
        ahead[t] = np.where(on[t + 1], np.log(np.exp(after - top) @ moves.T) + top, ahead[t + 1])
    return forward, ahead, _log_sum(forward[-1], 1)


def loss_and_gradients(model: Tagger, x: np.ndarray, mask: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Negative log-likelihood of the tag paths per row, and its gradient for each parameter."""
    traces: list = [[], []]
    scores, states = emissions(model, x, mask, traces)
    length, rows, _ = scores.shape
    on = mask.T[:, :, None]
    at = np.arange(rows)
    forward, ahead, total = sums(model, scores, mask)
    gold = scores[0, at, tags[:, 0]].astype(np.float64)
    gold += ((model.moves[tags[:, :-1], tags[:, 1:]] + np.take_along_axis(scores, tags.T[:, :, None], 2)[1:, :, 0].T) * mask[:, 1:]).sum(axis=1)
    # Expected moves: one product over all places, each scaled to stay in range.
    left = np.exp(forward[:-1] - forward[:-1].max(axis=2, keepdims=True))
    after = scores[1:] + ahead[1:]
    right = np.exp(after - after.max(axis=2, keepdims=True)) * on[1:]
    scale = np.exp(forward[:-1].max(axis=2) + after.max(axis=2) - total)[:, :, None]
    dmoves = (left * scale).reshape(-1, TAGS).T @ right.reshape(-1, TAGS) * np.exp(model.moves)
    taken = np.bincount((tags[:, :-1] * TAGS + tags[:, 1:]).ravel(), mask[:, 1:].ravel(), TAGS * TAGS)
    dmoves = dmoves - taken.reshape(TAGS, TAGS)
    dscores = np.exp(forward + ahead - total[None, :, None])
    dscores[np.arange(length)[:, None], at[None, :], tags.T] -= 1
    dscores = (dscores * on / rows).astype(scores.dtype)
    flat = dscores.reshape(-1, TAGS)
    dwo, dbo = states.reshape(len(flat), -1).T @ flat, flat.sum(axis=0)
    dstates = dscores @ model.wo.T
    hidden = model.wh[0].shape[0]
    dwx0, dwh0 = _lstm_back(x, model.wx[0], model.wh[0], traces[0], dstates[:, :, :hidden])
    dwx1, dwh1 = _lstm_back(x[:, ::-1], model.wx[1], model.wh[1], traces[1], dstates[::-1, :, hidden:])
    return float((total - gold).mean()), [dwx0, dwx1, dwh0, dwh1, dwo, dbo, dmoves / rows]


def packed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and mask of windows as arrays of ``WINDOW`` columns."""
    x, mask = np.zeros((len(texts), WINDOW), np.uint8), np.zeros((len(texts), WINDOW), np.float32)
    for row, text in enumerate(texts):
        x[row, : len(text)], mask[row, : len(text)] = codes(text), 1
    return x, mask


def fit(windows: list[tuple[str, list[Span]]], steps: int = STEPS, seed: int = 11) -> Tagger | None:
    """A tagger from windows and their labelled spans (Adam, fixed seed); None without windows."""
    if not any(spans for _, spans in windows):
        return None
    x, mask = packed([text for text, _ in windows])
    tags = np.zeros(x.shape, np.int64)
    for row, (_, spans) in enumerate(windows):
        for kind, start, end in spans:
            tags[row, start:end] = 2 + 2 * kind
            tags[row, start] = 1 + 2 * kind
    model, rng = Tagger.new(), np.random.default_rng(seed)
    weights = model.parameters()
    first, second, count = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    while count < steps:
        order = rng.permutation(len(x))
        for start in range(0, min(len(order), (steps - count) * BATCH), BATCH):
            rows = order[start : start + BATCH]
            _, gradients = loss_and_gradients(model, x[rows], mask[rows], tags[rows])
            norm = float(np.sqrt(sum((g**2).sum() for g in gradients)))
            count += 1
            rate = RATE * (1 - 0.9 * count / steps) * (1 - 0.999**count) ** 0.5 / (1 - 0.9**count)
            for w, g, a, b in zip(weights, gradients, first, second, strict=True):
                g = g / max(1.0, norm / 5)
                a += 0.1 * (g - a)
                b += 0.001 * (g**2 - b)
                w -= (rate * a / (np.sqrt(b) + 1e-8)).astype(w.dtype)
    return model


def best_paths(model: Tagger, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The CRF's best tags (rows, length), and of rows with a tag that is not outside the log of the tags' marginal probabilities."""
    scores = tag_scores(model, x, mask)
    length, _, rows = scores.shape
    whole, moves = mask.all(), np.ascontiguousarray(model.moves.T)[:, :, None]
    best, step, outside = np.empty_like(scores), np.empty((TAGS, TAGS, rows), scores.dtype), scores[0, 0].copy()
    best[0] = scores[0]
    for t in range(1, length):
        np.add(best[t - 1], moves, out=step)
        step.max(axis=1, out=best[t])
        best[t] += scores[t]
        after = outside + model.moves[0, 0] + scores[t, 0]
        if not whole:
            on = mask[:, t] > 0
            best[t] = np.where(on, best[t], best[t - 1])
            after = np.where(on, after, outside)
        outside = after
    tags, sure = np.zeros(x.shape, np.int64), np.zeros(x.shape, scores.dtype)
    # A row whose best score is that of the path that stays outside has that path; the others are followed back.
    some = np.flatnonzero(best[-1].max(axis=0) > outside)
    if len(some):
        mask, scores, best = mask[some], np.ascontiguousarray(scores[:, :, some].transpose(0, 2, 1)), best[:, :, some].transpose(0, 2, 1)
        path = np.empty((len(some), length), np.int64)
        path[:, -1] = best[-1].argmax(axis=1)
        for t in range(length - 1, 0, -1):
            path[:, t - 1] = np.where(mask[:, t] > 0, (best[t - 1] + model.moves.T[path[:, t]]).argmax(axis=1), path[:, t])
        tags[some] = path
        forward, ahead, total = sums(model, scores, mask)
        sure[some] = np.take_along_axis(forward + ahead, path.T[:, :, None], 2)[:, :, 0].T - total[:, None]
    return tags, sure


def window_starts(size: int) -> np.ndarray:
    """Where the windows of a text of ``size`` characters begin."""
    last = max(0, size - WINDOW)
    return np.append(np.arange(0, last, STEP), last)


Found = tuple[int, int, int, float, bool]


def path_spans(tags: np.ndarray, sure: np.ndarray, start: int, width: int, size: int) -> list[Found]:
    """(kind, start, end, score, cut) of one decoded window of ``width`` characters in a text of ``size``."""
    spans, i = [], 0
    while i < width:
        if tags[i] == 0:
            i += 1
            continue
        kind, first = (tags[i] - 1) // 2, i
        i += 1
        while i < width and tags[i] == 2 + 2 * kind:
            i += 1
        cut = first == 0 and start > 0 or i == width and start + width < size
        spans.append((int(kind), start + first, start + i, float(sure[first:i].sum()), cut))
    return spans


def reconciled(spans: list[Found]) -> list[Span]:
    """The spans of a whole text: cut pieces joined, then the non-overlapping set with the highest total score."""
    joined: list[list] = []
    for kind, start, end, score, cut in sorted(spans):
        last = joined[-1] if joined else None
        if last and last[0] == kind and start < last[2] and (cut or last[4] or (start, end) == (last[1], last[2])):
            mean = max(score / (end - start), last[3] / (last[2] - last[1]))
            last[2] = max(last[2], end)
            last[3], last[4] = mean * (last[2] - last[1]), last[4] or cut
        else:
            joined.append([kind, start, end, score, cut])
    sure = sorted((s for s in joined if s[3] / (s[2] - s[1]) >= SURE), key=lambda s: (s[2], s[1], s[0]))
    ends = [s[2] for s in sure]
    gains: list[tuple[float, list[Span]]] = [(0.0, [])]
    chosen: list[int] = []
    for i, (kind, start, end, score, _) in enumerate(sure):
        before = bisect_right(ends, start, 0, i)
        gain = gains[before][0] + (end - start) * (1 + score / (end - start))
        take = gain > gains[i][0]
        chosen.append(before if take else -1)
        gains.append((gain if take else gains[i][0], []))
    out, i = [], len(sure)
    while i > 0:
        if chosen[i - 1] >= 0:
            kind, start, end, _, _ = sure[i - 1]
            out.append((kind, start, end))
            i = chosen[i - 1]
        else:
            i -= 1
    return out[::-1]


def added_spans(model: Tagger | None, texts: list[str], base: list[list[Span]], every: bool = True) -> list[list[Span]]:
    """What the tagger adds to the base spans of each text. All windows are decoded, also for callers that give another ``every``."""
    found: list[list[Found]] = [[] for _ in texts]
    sizes = np.array([len(text) for text in texts], np.int64)
    if model and sizes.sum():
        whole = np.lib.stride_tricks.sliding_window_view(np.pad(codes("".join(texts)), (0, WINDOW)), WINDOW)
        starts = [window_starts(size) if size else np.empty(0, np.int64) for size in sizes.tolist()]
        owner, start = np.repeat(np.arange(len(texts)), [len(s) for s in starts]), np.concatenate(starts)
        places, widths = start + (np.cumsum(sizes) - sizes)[owner], np.minimum(sizes, WINDOW)[owner]
        for at in range(0, len(owner), CHUNK):
            part = slice(at, at + CHUNK)
            mask = (np.arange(WINDOW) < widths[part, None]).astype(np.float32)
            tags, sure = best_paths(model, np.where(mask > 0, whole[places[part]], 0), mask)
            for row in np.flatnonzero(tags.any(axis=1)):
                i, first, width = (int(v[at + row]) for v in (owner, start, widths))
                found[i] += path_spans(tags[row], sure[row], first, width, len(texts[i]))
    result = []
    for text, known, spans in zip(texts, base, found, strict=True):
        new = []
        for kind, start, end in reconciled(spans):
            while start < end and not (text[start].isalnum() or text[start] in "+("):
                start += 1
            while end > start and not text[end - 1].isalnum():
                end -= 1
            body = text[start:end]
            if holds(kind, body) and not any(s < end and start < e for _, s, e in known):
                new.append((kind, start, end))
        result.append(sorted(new))
    return result


# --- Spark ---

def learn(docs: DataFrame) -> Tagger | None:
    """The tagger of a corpus: from its labelled windows and from examples made in those of its windows that hold nothing."""
    windows = labelled_windows(docs)
    carriers = [text for text, spans in windows if not spans]
    return fit(windows + pii_examples.examples(carriers, MADE, WINDOW, 3)) if windows else None



def labelled_windows(docs: DataFrame, limit: int = MAX_WINDOWS) -> list[tuple[str, list[Span]]]:
    """Windows of the documents with their base spans as labels: at most ``limit`` with spans, half as many without.

    Windows that cut a span are left to their neighbours; which ones are taken is settled by a hash of the text.
    """
    counts = (limit // 2, limit)  # without and with spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task holds no more of either kind than can be taken in all.
        held: tuple[list, list] = ([], [])
        edges = [1 << 63, 1 << 63]  # windows with a larger hash are not taken
        for batch in batches:
            for text in batch.column(0).to_pylist():
                spans = base_spans(text)
                edge = max(edges) if spans else edges[0]
                for start in window_starts(len(text)).tolist() if text else []:
                    end = start + WINDOW
                    piece = text[start:end]
                    place = hashed(piece)
                    if place > edge:
                        continue
                    near = [s for s in spans if s[1] < end and start < s[2]]
                    if all(start <= s[1] and s[2] <= end for s in near):
                        near.sort(key=lambda s: (s[1], -s[2]))
                        apart = [s for k, s in enumerate(near) if all(s[1] >= o[2] for o in near[:k])]
                        held[bool(apart)].append((place, piece, [v - (start if k else 0) for s in apart for k, v in enumerate(s)]))
                for some, count in enumerate(counts):
                    if len(held[some]) > 2 * count:
                        held[some].sort()
                        del held[some][count:]
                        edges[some] = held[some][-1][0]
        for rows, count in zip(held, counts, strict=True):
            rows.sort()
            some = rows[:count]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in some], pa.int64()), pa.array([r[1] for r in some], pa.string()), pa.array([r[2] for r in some], pa.list_(pa.int32()))],
                ["h", "text", "spans"],
            )

    windows = materialise(map_batches(docs.select("text"), run, "h long, text string, spans array<int>"), "windows")
    taken = []
    for some in (True, False):
        part = windows.filter((F.size("spans") > 0) == some)
        for row in first_by(part, counts[some], F.col("h"), "text").collect():
            flat = list(row["spans"])
            taken.append((row["text"], [tuple(flat[k : k + 3]) for k in range(0, len(flat), 3)]))
    return taken


def hashed(text: str) -> int:
    """The signed 64-bit hash that Spark's ``xxhash64`` gives the text."""
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)
    return value - (1 << 64) if value >> 63 else value


def find(docs: DataFrame, model: Tagger | None, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``added``: arrays of (kind, start, end)."""
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                     T.StructField("end", T.IntegerType())]))
    rows = docs.drop("base", "added")
    fields = rows.schema.fields
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def column(spans: list[list[Span]]) -> pa.Array:
        return pa.array([[{"kind": KINDS[k], "start": s, "end": e} for k, s, e in one] for one in spans], kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(text).to_pylist()]
                base = [base_spans(t) for t in texts]
                added = added_spans(shared.value, texts, base)
                yield pa.RecordBatch.from_arrays([*part.columns, column(base), column(added)], [*part.schema.names, "base", "added"])

    return map_batches(rows, run, T.StructType([*fields, T.StructField("base", span), T.StructField("added", span)]))


def redact(docs: DataFrame, model: Tagger | None) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets; ``n_chars`` follows the new text."""
    fields = docs.schema.fields
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column("text").to_pylist()
                base = [base_spans(t) for t in texts]
                added = added_spans(shared.value, [t or "" for t in texts], base)
                new = [t and replaced(t, b + a) for t, b, a in zip(texts, base, added, strict=True)]
                columns = dict(zip(part.schema.names, part.columns, strict=True)) | {"text": pa.array(new, pa.string())}
                if "n_chars" in columns:
                    sizes = [o if t is None else len(t) for o, t in zip(columns["n_chars"].to_pylist(), new, strict=True)]
                    columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
                yield pa.RecordBatch.from_pydict(columns)

    return map_batches(docs, run, T.StructType(fields))


def replaced(text: str, spans: list[Span]) -> str:
    """The text with its spans replaced; overlapping spans become one, named by the first."""
    out, last, name = [], 0, ""
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= last or not name:
            out.append(text[last:start])
            name = f"[{KINDS[kind].upper()}]"
            out.append(name)
        last = max(last, end)
    return "".join(out) + text[last:]
