"""Personal data: patterns, and a character tagger (bidirectional LSTM with CRF transitions) in numpy.

The tagger is trained here on windows of labelled spans from a sample of documents with fixed bounds. Labels are the
pattern matches, the same spans written in other ways (no ``+``, other separators, "(at)" and "dot", defanged addresses), and
secrets: values of assignments to names such as "token", and made-up keys of several alphabets put in their place. So it learns spans
that no pattern finds, and secrets as a kind of their own.

It then reads every text whole, in overlapping windows longer than those of the training. Each window is decoded by
Viterbi, each character takes its tag from the window in which it is furthest from an edge, and runs of a tag over the whole
text are the spans; a secret is the whole run of key characters around its tags. No window is left out.
What the tagger finds is added where it touches no pattern match and has the shape of its kind.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
# The tagger knows one kind more than the patterns.
SECRET = "secret"
ALL_KINDS = (*KINDS, SECRET)
TAGS = len(ALL_KINDS) + 1
WINDOW = 64
STRIDE = WINDOW // 2
# Windows to read are longer than those to train on, so that few characters are read twice; a tag within ``EDGE`` characters of a
# window's end, inside a text, comes from the neighbour.
READ = 4 * WINDOW
EDGE = WINDOW // 4
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]")
_WRITTEN_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+ ?(?:@|[(\[]at[)\]]| at ) ?[A-Za-z0-9-]+(?: ?(?:\.|[(\[]dot[)\]]| dot ) ?[A-Za-z0-9-]+)+")
_WRITTEN_IP = re.compile(r"[0-9]{1,3}(?:(?: ?\. ?|\[\.\])[0-9]{1,3}){3}")
_WRITTEN_CARD = re.compile(r"[0-9](?:[\x20./_-]?[0-9])+")
_KEY_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-")
_SHORTEST_SECRET = 16
# Names whose assigned value is a secret, in training.
_ASSIGNED = re.compile(
    r"(?i)(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|auth|bearer)[\"']?\s*[:=]\s*[\"']?([A-Za-z0-9+/=_-]{16,})")

Span = tuple[str, int, int]


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def small_parts(text: str) -> bool:
    return all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in text.split("."))


def pattern_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that pass its test, by kind and start."""
    found: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    if not _DIGIT.search(text):
        return found
    for run in _DOTTED.finditer(text):
        if run.group().count(".") >= 3:
            found += [("ip", run.start() + m.start(), run.start() + m.end())
                      for m in _IP.finditer(run.group()) if small_parts(m.group())]
    for m in _CARD.finditer(text):
        digits = digits_of(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return found


def plausible(kind: str, text: str) -> bool:
    """Shape that a tagged span must have to count."""
    digits = digits_of(text)
    if kind == "email":
        return _WRITTEN_EMAIL.fullmatch(text) is not None
    if kind == "ip":
        return _WRITTEN_IP.fullmatch(text) is not None and all(int(p) <= 255 for p in re.findall("[0-9]+", text))
    if kind == "card":
        return 13 <= len(digits) <= 19 and _WRITTEN_CARD.fullmatch(text) is not None and luhn(digits)
    if kind == SECRET:
        letters = sum(c.isalpha() for c in text)
        return (len(text) >= _SHORTEST_SECRET and all(c in _KEY_SIGNS for c in text) and letters >= 4 and len(digits) >= 3
                and len(set(text)) >= 8)
    return 8 <= len(digits) <= 15 and re.fullmatch(r"\+?[\x20().0-9-]+", text) is not None and len(digits) < len(text)


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (ALL_KINDS.index(s[0]), s[1], s[2])))


# Character classes: digit, lower, upper, other letter or sign, and some signs of their own; 0 pads.
_SIGNS = " \n\t.,:;@+-_%()/\"'=#*"
CLASSES = 5 + len(_SIGNS)
_CLASS_OF = np.full(129, 4, np.uint8)
_CLASS_OF[48:58], _CLASS_OF[97:123], _CLASS_OF[65:91] = 1, 2, 3
for _i, _c in enumerate(_SIGNS):
    _CLASS_OF[ord(_c)] = 5 + _i


def classes_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASS_OF.take(np.minimum(codes, 128))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Lstm:
    """One direction over (time, batch) class numbers; the input layer is a table per class."""

    def __init__(self, hidden: int, rng: np.random.Generator):
        self.hidden = hidden
        self.params = {"table": rng.normal(0, 0.3, (CLASSES, 4 * hidden)), "back": rng.normal(0, 0.3, (hidden, 4 * hidden))}
        self.params["table"][:, hidden:2 * hidden] += 1.0

    def forward(self, x: np.ndarray, keep: bool = False):
        h = c = np.zeros((x.shape[1], self.hidden), self.params["table"].dtype)
        out, memory, n = np.empty((*x.shape, self.hidden), h.dtype), [], self.hidden
        for t in range(len(x)):
            z = self.params["table"][x[t]] + h @ self.params["back"]
            gates, new = _sigmoid(z[:, :3 * n]), np.tanh(z[:, 3 * n:])
            before, c = c, gates[:, n:2 * n] * c + gates[:, :n] * new
            squash = np.tanh(c)
            if keep:
                memory.append((gates, new, before, squash, h))
            h = gates[:, 2 * n:] * squash
            out[t] = h
        return out, memory

    def read(self, x: np.ndarray) -> np.ndarray:
        """Output of :meth:`forward` alone, with the four gates apart; one tanh gives them all, as sigmoid(z) = tanh(z / 2) / 2 + 1 / 2."""
        n = self.hidden
        half = np.array([0.5, 0.5, 0.5, 1], self.params["table"].dtype)[:, None, None]
        table, back = (np.ascontiguousarray(self.params[k].reshape(-1, 4, n).transpose(1, 0, 2)) * half for k in ("table", "back"))
        h = c = np.zeros((x.shape[1], n), table.dtype)
        out = np.empty((*x.shape, n), h.dtype)
        for t in range(len(x)):
            z = h @ back
            z += table.take(x[t], axis=1)
            np.tanh(z, out=z)
            z[:3] *= 0.5
            z[:3] += 0.5
            c = z[1] * c + z[0] * z[3]
            h = np.multiply(z[2], np.tanh(c), out=out[t])
        return out

    def backward(self, x: np.ndarray, memory: list, d_out: np.ndarray) -> dict[str, np.ndarray]:
        n = self.hidden
        grad = {k: np.zeros_like(v) for k, v in self.params.items()}
        dh, dc = np.zeros(d_out.shape[1:]), np.zeros(d_out.shape[1:])
        for t in range(len(x) - 1, -1, -1):
            gates, new, before, squash, h = memory[t]
            dh = dh + d_out[t]
            dc = dc + dh * gates[:, 2 * n:] * (1 - squash ** 2)
            dz = np.concatenate([dc * new, dc * before, dh * squash], axis=1) * gates * (1 - gates)
            dz = np.concatenate([dz, dc * gates[:, :n] * (1 - new ** 2)], axis=1)
            np.add.at(grad["table"], x[t], dz)
            grad["back"] += h.T @ dz
            dh, dc = dz @ self.params["back"].T, dc * gates[:, n:2 * n]
        return grad


class Tagger:
    """Bidirectional LSTM with a linear-chain CRF on top."""

    def __init__(self, hidden: int = 12, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.ahead, self.behind = Lstm(hidden, rng), Lstm(hidden, rng)
        self.top = {"out": rng.normal(0, 0.3, (2 * hidden, TAGS)), "bias": np.zeros(TAGS), "step": np.zeros((TAGS, TAGS))}

    def groups(self) -> list[dict[str, np.ndarray]]:
        return [self.ahead.params, self.behind.params, self.top]

    def compact(self) -> Tagger:
        for group in self.groups():
            for name in group:
                group[name] = group[name].astype(np.float32)
        return self

    def _scores(self, x: np.ndarray, keep: bool = False):
        one, memory = self.ahead.forward(x, keep)
        two, other = self.behind.forward(x[::-1], keep)
        both = np.concatenate([one, two[::-1]], axis=2)
        return both @ self.top["out"] + self.top["bias"], both, memory, other

    def loss(self, x: np.ndarray, tags: np.ndarray) -> tuple[float, list[dict[str, np.ndarray]]]:
        """Mean negative log likelihood of (time, batch) tags, and gradients."""
        scores, both, memory, other = self._scores(x, keep=True)
        steps, batch, move = len(x), x.shape[1], self.top["step"]
        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[0] = scores[0]
        for t in range(1, steps):
            alpha[t] = scores[t] + _logsumexp(alpha[t - 1][:, :, None] + move, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = _logsumexp(move + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _logsumexp(alpha[-1], 1)
        rows = np.arange(batch)
        told = sum(scores[t, rows, tags[t]] for t in range(steps)) + move[tags[:-1], tags[1:]].sum(axis=0)
        d_scores = np.exp(alpha + beta - total[:, None])
        d_move = np.zeros_like(move)
        for t in range(steps):
            d_scores[t, rows, tags[t]] -= 1
            if t:
                pair = alpha[t - 1][:, :, None] + move + (scores[t] + beta[t])[:, None, :] - total[:, None, None]
                d_move += np.exp(pair).sum(axis=0)
        np.subtract.at(d_move, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        d_scores, d_move = d_scores / batch, d_move / batch
        d_both = d_scores @ self.top["out"].T
        n = self.ahead.hidden
        top = {"out": np.einsum("tbh,tbk->hk", both, d_scores), "bias": d_scores.sum(axis=(0, 1)), "step": d_move}
        return float((total - told).mean()), [
            self.ahead.backward(x, memory, d_both[:, :, :n]),
            self.behind.backward(x[::-1], other, d_both[::-1, :, n:]), top]

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tags, (time, batch)."""
        ahead, behind, n = self.ahead.read(x), self.behind.read(x[::-1])[::-1], self.ahead.hidden
        out, step = self.top["out"], self.top["step"][:, :, None]
        # (time, tag, batch): the best score of a path that ends in each tag; and of the path outside all spans.
        best, outside = np.empty((len(x), TAGS, x.shape[1]), out.dtype), 0
        for t in range(len(x)):
            scores = best[t]
            scores[:] = (ahead[t] @ out[:n] + behind[t] @ out[n:] + self.top["bias"]).T
            outside = scores[0] + (outside + step[0, 0] if t else 0)
            if t:
                scores += (best[t - 1][:, None, :] + step).max(axis=0)
        tags = np.zeros(x.shape, np.int8)
        # Where no path beats the one outside all spans, it is the answer; the others are traced back.
        some = np.flatnonzero(best[-1].max(axis=0) > outside)
        best, into = np.ascontiguousarray(best[:, :, some].transpose(0, 2, 1)), np.ascontiguousarray(self.top["step"].T)
        now = best[-1].argmax(axis=1)
        tags[-1, some] = now
        for t in range(len(x) - 1, 0, -1):
            now = (best[t - 1] + into[now]).argmax(axis=1)
            tags[t - 1, some] = now
        return tags


def train(windows: list[tuple[np.ndarray, np.ndarray]], steps: int = 240, batch: int = 64, rate: float = 0.02,
          seed: int = 7) -> Tagger:
    """Adam on windows of (classes, tags), all of ``WINDOW`` characters."""
    tagger, rng = Tagger(seed=seed), np.random.default_rng(seed)
    x, y = (np.stack(c) for c in zip(*windows, strict=True))
    first = [{k: np.zeros_like(v) for k, v in g.items()} for g in tagger.groups()]
    second = [{k: np.zeros_like(v) for k, v in g.items()} for g in tagger.groups()]
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(x), batch)
        _, grads = tagger.loss(np.ascontiguousarray(x[pick].T), np.ascontiguousarray(y[pick].T))
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for group, grad, m, v in zip(tagger.groups(), grads, first, second, strict=True):
            for k in group:
                g = np.clip(grad[k], -5, 5)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                group[k] -= pace * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return tagger.compact()


def window_starts(text: str) -> list[int]:
    """Starts of the windows that a text is read in; together they cover it."""
    return list(range(0, max(len(text) - 2 * EDGE, 1), READ - 2 * EDGE)) if text else []


def marked_starts(text: str) -> list[int]:
    """Starts of the training windows that hold a digit, an ``@`` or an "(at)"; windows begin every ``STRIDE`` characters."""
    starts: dict[int, None] = {}
    for m in _TRIGGER.finditer(text):
        last = m.start() // STRIDE * STRIDE
        for start in (last - STRIDE, last):
            if start >= 0:
                starts[start] = None
    return sorted(starts)


def _padded(classes: np.ndarray, start: int) -> np.ndarray:
    out = np.zeros(WINDOW, np.int64)
    part = classes[start:start + WINDOW]
    out[:len(part)] = part
    return out


def tagged_spans(texts: list[str], tagger: Tagger, chunk: int = 1024) -> list[list[Span]]:
    """Spans of every text from its decoded windows, reconciled over the whole text."""
    found: list[list[Span]] = [[] for _ in texts]
    # The last window of a text ends with it, padded to a multiple of ``WINDOW``; windows of one length are decoded together.
    jobs: dict[int, list[tuple[int, int]]] = {}
    for i, text in enumerate(texts):
        for s in window_starts(text):
            jobs.setdefault(-(-min(READ, len(text) - s) // WINDOW) * WINDOW, []).append((i, s))
    pieces: dict[int, list[tuple[int, np.ndarray]]] = {}
    for size, alike in jobs.items():
        classes, owner = np.empty(0, np.uint8), -1
        for at in range(0, len(alike), chunk):
            some = alike[at:at + chunk]
            rows = np.zeros((len(some), size), np.uint8)
            for k, (i, s) in enumerate(some):
                if i != owner:
                    classes, owner = classes_of(texts[i]), i
                part = classes[s:s + size]
                rows[k, :len(part)] = part
            tags = tagger.decode(np.ascontiguousarray(rows.T)).T
            for k in np.flatnonzero(tags.any(axis=1)).tolist():
                (i, s), row = some[k], tags[k]
                low = 0 if s == 0 else EDGE
                high = len(texts[i]) - s if s + READ >= len(texts[i]) else READ - EDGE
                if row[low:high].any():
                    pieces.setdefault(i, []).append((s + low, row[low:high]))
    for i, parts in pieces.items():
        kind, start, last = 0, 0, -1
        for begin, row in sorted(parts, key=lambda p: p[0]):
            for place in np.flatnonzero(row).tolist():
                if row[place] != kind or begin + place != last + 1:
                    if kind:
                        found[i].append((ALL_KINDS[kind - 1], start, last + 1))
                    kind, start = int(row[place]), begin + place
                last = begin + place
        if kind:
            found[i].append((ALL_KINDS[kind - 1], start, last + 1))
    return found


def added_spans(text: str, base: list[Span], tagged: list[Span]) -> list[Span]:
    """Tagged spans, without signs at their ends, that look like their kind and touch no pattern match.

    A secret reaches as far as its characters do, if at least half of it was tagged.
    """
    out: list[Span] = []
    for kind, start, end in tagged:
        if kind == SECRET:
            if out and out[-1][0] == SECRET and start < out[-1][2]:
                continue
            low, high = start, end
            while low > 0 and text[low - 1] in _KEY_SIGNS:
                low -= 1
            while high < len(text) and text[high] in _KEY_SIGNS:
                high += 1
            told = sum(min(high, b) - max(low, a) for k, a, b in tagged if k == SECRET and a < high and low < b)
            if 2 * told < high - low:
                continue
            start, end = low, high
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        if plausible(kind, text[start:end]) and not any(start < b and a < end for _, a, b in base):
            out.append((kind, start, end))
    return out


def labelled_spans(text: str) -> list[Span]:
    """Spans to train on: pattern matches and assigned secrets that touch none of them."""
    base = pattern_spans(text)
    return base + [(SECRET, m.start(1), m.end(1)) for m in _ASSIGNED.finditer(text)
                   if plausible(SECRET, m.group(1)) and not any(m.start(1) < b and a < m.end(1) for _, a, b in base)]


_ALPHABETS = ("0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
              "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "abcdefghijklmnopqrstuvwxyz0123456789_-")


def rewritten(kind: str, text: str, rng: np.random.Generator) -> str:
    """The same kind of data, written in a way that the patterns do not cover."""
    def one(*ways: str) -> str:
        return ways[rng.integers(len(ways))]

    if kind == "email":
        local, _, domain = text.partition("@")
        return local + one(" at ", " (at) ", "(at)", "[at]", " [at] ") + domain.replace(".", one(".", " dot ", "(dot)", "[dot]"))
    if kind == "ip":
        return text.replace(".", one("[.]", " . ", ". "))
    if kind == "card":
        digits = digits_of(text)
        return one(".", "/", "_", "  ").join(digits[i:i + 4] for i in range(0, len(digits), 4))
    if kind == "phone":
        digits, sign = digits_of(text), one("-", ".", " ")
        cuts = [digits[:-7], digits[-7:-4], digits[-4:]]
        return one(f"({cuts[0]}) {cuts[1]}{sign}{cuts[2]}", sign.join(cuts), f"00 {sign.join(cuts)}", f"{cuts[0]}/{cuts[1]}{sign}{cuts[2]}")
    alphabet = _ALPHABETS[rng.integers(len(_ALPHABETS))]
    return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), rng.integers(20, 56)))


def training_windows(text: str, per_text: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(classes, tags) of up to ``2 * per_text`` windows with a trigger, half of them with spans, up to ``per_text`` in which a span
    is written otherwise, and one without a trigger, of texts that have one. They are picked by hash over the whole text."""
    spans, starts = labelled_spans(text), marked_starts(text)
    seed = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    order = sorted(starts, key=lambda s: zlib.crc32(s.to_bytes(8, "little"), seed))
    tags = np.zeros(len(text), np.int64)
    for kind, a, b in spans:
        tags[a:b] = ALL_KINDS.index(kind) + 1
    classes, out = classes_of(text), []
    held = {s: bool(tags[s:s + WINDOW].any()) for s in order}
    for want in (True, False):
        out += [(_padded(classes, s), _padded(tags, s)) for s in [s for s in order if held[s] is want][:per_text]]
    plain = set(range(0, len(text), STRIDE)) - set(starts) if starts else ()
    out += [(_padded(classes, s), _padded(tags, s)) for s in sorted(plain, key=lambda s: zlib.crc32(s.to_bytes(8, "little"), seed))[:1]]
    rng = np.random.default_rng(seed)
    for kind, a, b in sorted(spans, key=lambda s: zlib.crc32(s[1].to_bytes(8, "little"), seed))[:per_text]:
        body = rewritten(kind, text[a:b], rng)
        before = text[max(0, a - int(rng.integers(0, WINDOW))):a] if rng.integers(4) else text[max(0, a - 8):a]
        if kind == SECRET and rng.integers(2):
            # Not every secret is assigned: it stands between blanks.
            before = text[max(0, a - WINDOW):a].split("=")[0].rstrip(": ") + " "
        other = before + body + text[b:b + WINDOW]
        marks = np.zeros(len(other), np.int64)
        marks[len(before):len(before) + len(body)] = ALL_KINDS.index(kind) + 1
        start = max(0, len(before) - int(rng.integers(0, WINDOW // 2)))
        out.append((_padded(classes_of(other), start), _padded(marks, start)))
    return out


def _training_windows(per_text: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(x.tolist(), y.tolist()) for text in batch["text"] for x, y in training_windows(text, per_text)]
            if rows:
                yield pd.DataFrame(rows, columns=["classes", "tags"])

    return run


def fit_tagger(docs: DataFrame, max_docs: int = 1500, per_text: int = 2, doc_id: str = "doc_id",
               text: str = "text", steps: int = 400) -> Tagger | None:
    """Train on windows (see :func:`training_windows`) of ``max_docs`` documents with a digit, an ``@`` or an "(at)", by hash of the id.

    None if no window holds a labelled span: the tagger then adds nothing.
    """
    body = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    # The sample is picked by hashes alone, so no task gathers texts of more documents than it has.
    known = body.withColumn("hash", F.xxhash64("text"))
    chosen = (known.where(F.col("text").rlike(_TRIGGER.pattern)).select(F.xxhash64("id").alias("of"), F.col("hash").alias("h"))
              .distinct().orderBy("of", "h").limit(max_docs))
    texts = known.join(F.broadcast(chosen), (F.xxhash64("id") == F.col("of")) & (F.col("hash") == F.col("h")))
    picked = (texts.groupBy("of", "h").agg(F.min("text").alias("text")).select("text")
              .mapInPandas(_training_windows(per_text), "classes array<long>, tags array<long>").collect())
    windows = [(np.array(r["classes"]), np.array(r["tags"])) for r in picked]
    if not any(tags.any() for _, tags in windows):
        return None
    return train(sorted(windows, key=lambda w: (w[0].tobytes(), w[1].tobytes())), steps)


def find_pii(docs: DataFrame, tagger: Tagger | None, text: str = "text") -> DataFrame:
    """``docs`` with ``n_email, n_ip, n_card, n_phone`` and ``base_spans`` (patterns) and ``spans`` (with the tagger's);
    these replace columns of their names.

    Spans are ``kind:start:end`` in code points, end exclusive, comma-joined, by kind and start. Null and
    empty texts have none. Rows in, rows out.
    """
    columns = [f"n_{k}" for k in KINDS] + ["base_spans", "spans"]

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string")
    def scan(bodies: pd.Series) -> pd.DataFrame:
        rows = []
        texts = [b if isinstance(b, str) else "" for b in bodies]
        for at in range(0, len(texts), 500):
            some = texts[at:at + 500]
            tagged = tagged_spans(some, tagger) if tagger else [[] for _ in some]
            for body, extra in zip(some, tagged, strict=True):
                base = pattern_spans(body)
                rows.append((*(sum(k == s[0] for s in base) for k in KINDS), written(base),
                             written(base + added_spans(body, base, extra))))
        return pd.DataFrame(rows, columns=columns, dtype=object)

    out = docs.withColumn("spans", scan(F.col(f"`{text}`")))
    return out.withColumns({c: F.col("spans")[c] for c in columns})
