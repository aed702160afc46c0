"""Personal data: fixed patterns plus a semi-Markov conditional random field.

The patterns find e-mail addresses, IP addresses, card numbers (Luhn) and
phone numbers in their usual forms.  The field finds other forms of the same four kinds
("name [at] host [dot] org", "0049 ..." or a number after "phone", "10[.]0[.]0[.]1", cards
grouped by other marks).  It scores whole segments of up to
``MAX_TOKENS`` tokens by features of the whole span -- digits and groups,
marks between them, Luhn, parts up to 255, what stands on either side, the
nearest telling word before it -- and a segment's type follows the
type before it by a transition score.  Tokens outside are segments of their own,
of type "none" and score 0.  Dynamic programming over the bounded segments chooses boundaries and
types together.

The field is fitted on a bounded sample of the documents themselves: at most
``PER_KIND`` distinct passages of each kind, and as many with digits but without any, labelled
by the patterns, and the same passages with the span rewritten in other
forms.  Training maximises the conditional likelihood (forward-backward over all
segmentations).  Where a kind has no passage, nothing of this kind is added; the pattern spans
never depend on the field.

Work and memory follow the text: only the surroundings of digits and at-signs
are cut into tokens, and they are read in pieces of about ``PIECE`` tokens.
Surroundings of over ``LONGEST`` code points are divided at a line end, which no
segment crosses; only where there is none, at a space.

Defined results: positions are code points, end exclusive; a null or empty
text has no span; an added span never touches a pattern span; texts of any length
are read whole; rows are independent, so repeated rows and ties need no rule;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyframe.llm.common import text_of

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
# The patterns of the contract.
BASE = (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        re.compile(r"[0-9]([\x20-]?[0-9])+"),
        re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))
NOT_DIGIT, DIGIT = re.compile("[^0-9]"), re.compile("[0-9]")

# Telling words before a span.
CUES = {PHONE: "phone tel telephone telefon téléphone teléfono call mobile cell handy fax whatsapp sms",
        CARD: "card visa mastercard amex credit debit carte karte kreditkarte tarjeta cc",
        IP: "ip ipv4 host server addr address ping ssh gateway",
        EMAIL: "mail email e-mail contact write reach",
        4: "version v isbn issn id order invoice page no nr license licence token ref case"}
CUE_OF = {w: k for k, words in CUES.items() for w in words.split()}

PER_KIND, MAX_TOKENS, BEFORE, AFTER, PIECE, LONGEST = 60, 20, 60, 40, 50_000, 20_000
ROUNDS, RATE, RIDGE = 90, 0.25, 0.02
# One class first, which the search skips to: digits, "@", or "at" in brackets.
TRIGGER = re.compile(r"[0-9@\[({<](?:(?<=[0-9])[0-9]*|(?<=@)|(?<=[\[({<]) ?[aA][tT] ?[\])}>])")
TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|[^\s]")
NUMERIC, MAILISH = set("+()[].-/ "), set("._%+-@[](){}<>")


# ---------------------------------------------------------------- patterns
def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) < 256


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns, by kind, then start."""
    out = []
    if "@" in text:
        out += [(EMAIL, *m.span()) for m in BASE[EMAIL].finditer(text)]
    if not DIGIT.search(text):
        return out
    out += [(IP, *m.span()) for m in BASE[IP].finditer(text) if all(map(byte, m.group().split(".")))]
    for m in BASE[CARD].finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((CARD, *m.span()))
    if "+" in text:
        out += [(PHONE, *m.span()) for m in BASE[PHONE].finditer(text)
                if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15]
    return out


# ---------------------------------------------------------------- segments
def regions(text: str) -> list[tuple[int, int]]:
    """The surroundings of digits and at-signs, merged where they meet; those
    over ``LONGEST`` code points are cut, at line ends where there are any."""
    out: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        lo, hi = max(0, m.start() - BEFORE), min(len(text), m.end() + AFTER)
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    cut = []
    for lo, hi in out:
        while hi - lo > LONGEST:
            end = text.rfind("\n", lo + LONGEST // 2, lo + LONGEST) + 1
            end = end or text.rfind(" ", lo + LONGEST // 2, lo + LONGEST) + 1 or lo + LONGEST
            cut.append((lo, end))
            lo = end
        cut.append((lo, hi))
    return cut


# Sizes of the feature groups, each one-hot; see ``Lattice.features``.
GROUPS = (21, MAX_TOKENS + 1, 10, 21, 6, 64, 3, 3, 6, 3, 3, 3, 3, 2)
OFFSETS = np.concatenate([[0], np.cumsum(GROUPS)])


class Lattice:
    """Tokens of some regions and the segments that may be entities.

    Segments hold digits and the marks between them (types ip, card, phone)
    or one at-sign and a name (type email)."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        start, end, text, region = [], [], [], []
        for r, (t, lo, hi) in enumerate(spans):
            for m in TOKEN.finditer(t, lo, hi):
                start.append(m.start())
                end.append(m.end())
                text.append(m.group())
                region.append(r)
        self.spans, self.tokens = spans, text
        self.start, self.end = np.array(start, np.int64), np.array(end, np.int64)
        self.region = np.array(region, np.int64)
        n = len(text)
        self.n = n
        first = [t[0] for t in text]
        self.digit = np.array(["0" <= c <= "9" for c in first], bool)
        self.length = self.end - self.start
        low = [t.lower() for t in text]
        bracket = np.array([c in "[({<" for c in first], bool)
        at_word = np.array([t == "at" for t in low], bool)
        wrapped = np.zeros(n, bool)
        wrapped[1:] = bracket[:-1]
        self.at = np.array([c == "@" for c in first], bool) | (at_word & wrapped)
        self.plain_at = np.array([c == "@" for c in first], bool)
        self.dot = np.array([c == "." for c in first], bool) | (np.array([t == "dot" for t in low], bool) & wrapped)
        self.letter = np.array([c.isalpha() for c in first], bool)
        numeric = np.array([c in NUMERIC for c in first], bool) | self.digit
        mailish = np.array([c in MAILISH for c in first], bool) | self.digit | self.letter
        gap = np.zeros(n, np.int64)
        if n:
            gap[1:] = self.start[1:] - self.end[:-1]
        new = np.ones(n, bool)
        new[1:] = self.region[1:] != self.region[:-1]
        line = np.array([g > 0 and not s and "\n" in spans[r][0][a - g:a] for g, s, r, a in
                         zip(gap, new, region, start)], bool)
        joint = self.at | self.dot | bracket | np.array([c in "])}>" for c in first], bool)
        beside = np.zeros(n, bool)
        beside[1:] = joint[1:] | joint[:-1]
        sums = lambda x: np.concatenate([[0], np.cumsum(x)])
        self.sum = {"digits": sums(np.where(self.digit, self.length, 0)), "groups": sums(self.digit),
                    "odd": sums(~numeric), "unmail": sums(~mailish), "at": sums(self.at), "plain": sums(self.plain_at),
                    "dots": sums(self.dot), "far": sums((gap > 2) | line | new), "loose": sums(((gap > 0) & ~beside) | line | new),
                    "four": sums(self.digit & (self.length == 4)), "gaps": sums(gap > 0)}
        for name, marks in (("dot", "."), ("dash", "-"), ("slash", "/"), ("round", "()"), ("square", "[]")):
            self.sum[name] = sums(np.array([c in marks for c in first], bool))
        self.byte = np.array([d and byte(t) for d, t in zip(self.digit, text)], bool)
        self.head = np.array([0 if d and t.startswith("00") else 1 if d and t[0] == "0" else 2 if d else
                              3 if t[0] == "+" else 4 if t[0] == "(" else 5 for d, t in zip(self.digit, text)], np.int64)
        self.left = np.array([self._side(spans[r][0], a - 1, -1) for r, a in zip(region, start)], np.int64)
        self.right = np.array([self._side(spans[r][0], b, 1) for r, b in zip(region, end)], np.int64)
        cue = np.array([CUE_OF.get(t, -1) for t in low], np.int64)
        last = np.maximum.accumulate(np.where(cue >= 0, np.arange(n), -1)) if n else np.zeros(0, np.int64)
        self.cue = np.zeros(n, np.int64)
        if n:
            before = np.concatenate([[-1], last[:-1]])
            near = (before >= np.arange(n) - 5) & (before >= 0) & (self.region[before] == self.region)
            self.cue = np.where(near, cue[before] + 1, 0)
        self._segments()

    @staticmethod
    def _side(text: str, i: int, way: int) -> int:
        """What touches a span: 0 nothing, 1 a letter or digit, 2 a joining mark."""
        if i < 0 or i >= len(text):
            return 0
        c = text[i]
        if c.isalnum() or c == "_":
            return 1
        if way > 0 and c in ".:-" and (i + 1 == len(text) or not text[i + 1].isalnum()):
            return 0
        return 2 if c in ("-/.+@#$%&\\~" if way < 0 else "-/.+@#$%&=\\:~") else 0

    def _total(self, name, i, j):
        return self.sum[name][j] - self.sum[name][i]

    def _segments(self) -> None:
        """(i, j) tokens, and whether the segment is for the type email."""
        starts, ends, mails = [], [], []
        at = np.arange(self.n)
        for size in range(1, MAX_TOKENS + 1):
            i = at[:max(0, self.n - size + 1)]
            j = i + size
            digits, groups = self._total("digits", i, j), self._total("groups", i, j)
            number = ((self._total("odd", i, j) == 0) & (self._total("far", i + 1, j) == 0) & self.digit[j - 1]
                      & ((self.head[i] < 5)) & (digits >= 4) & (digits <= 19) & ((digits >= 7) | (groups == 4)))
            mail = ((self._total("at", i, j) == 1) & (self._total("unmail", i, j) == 0)
                    & (self._total("loose", i + 1, j) == 0) & (self.letter[i] | self.digit[i])
                    & self.letter[j - 1] & ~self.at[i] & ~self.at[j - 1] & (self._total("dots", i, j) > 0))
            for keep, flag in ((number, 0), (mail, 1)):
                starts.append(i[keep])
                ends.append(j[keep])
                mails.append(np.full(int(keep.sum()), flag))
        self.i, self.j, self.mail = (np.concatenate(x).astype(np.int64) for x in (starts, ends, mails))
        self.feats = self.features(self.i, self.j)

    def features(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """One index of each group for every segment."""
        digits, groups = self._total("digits", i, j), self._total("groups", i, j)
        longest = np.zeros(len(i), np.int64)
        for k in range(MAX_TOKENS):
            inside = i + k < j
            t = np.minimum(i + k, max(self.n - 1, 0))
            longest = np.maximum(longest, np.where(inside & self.digit[t], self.length[t], 0))
        marks = sum((self._total(name, i, j) > 0) << b
                    for b, name in enumerate(("dot", "dash", "slash", "round", "square")))
        marks = marks + ((self._total("gaps", np.minimum(i + 1, j), j) > 0) << 5)
        check = np.zeros(len(i), np.int64)
        for s in np.flatnonzero((digits >= 13) & (digits <= 19)):
            check[s] = 2 if luhn("".join(t for t in self.tokens[i[s]:j[s]] if t[0].isdigit() and t.isascii())) else 1
        four = np.zeros(len(i), np.int64)
        quads = (groups == 4) & (self._total("dot", i, j) == 3) & (self._total("dash", i, j) + self._total("slash", i, j) == 0)
        for s in np.flatnonzero(quads):
            k = np.arange(i[s], j[s])
            four[s] = 1 if self.byte[k[self.digit[k]]].all() else 2
        marker = np.where(self._total("plain", i, j) > 0, 1, np.where(self._total("at", i, j) > 0, 2, 0))
        ending = np.where(marker == 0, 0, np.where(
            (self._total("dots", np.maximum(j - 4, i), j) > 0) & (self.length[j - 1] >= 2) & (self.length[j - 1] <= 6), 1, 2))
        even = ((self._total("four", i, j) >= groups - 1) & (groups >= 3)).astype(np.int64)
        columns = (np.minimum(digits, 20), np.minimum(j - i, MAX_TOKENS), np.minimum(groups, 9), np.minimum(longest, 20),
                   self.head[i], marks, check, four, self.cue[i], self.left[i], self.right[j - 1], marker, ending, even)
        return np.stack(columns, 1) + OFFSETS[:-1]

    def found(self, s: int) -> tuple[int, int, int]:
        """(region, start, end) of a segment."""
        return int(self.region[self.i[s]]), int(self.start[self.i[s]]), int(self.end[self.j[s] - 1])


# ---------------------------------------------------------------- the field
def empty_weights() -> tuple[np.ndarray, np.ndarray]:
    """Segment weights by feature and kind, transitions by type (0: none)."""
    return np.zeros((int(OFFSETS[-1]) + 1, 4)), np.zeros((5, 5))


def segment_scores(lat: Lattice, weights: np.ndarray) -> np.ndarray:
    """Score of every segment as each kind; minus infinity where it may not be."""
    s = weights[lat.feats].sum(1) + weights[-1]
    mail = lat.mail == 1
    s[~mail, EMAIL] = -np.inf
    s[mail, 1:] = -np.inf
    return s


def log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(-1, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - top).sum(-1)) + top[..., 0]


class Likelihood:
    """Log-likelihood of labelled regions and its gradient."""

    def __init__(self, lat: Lattice, gold: list[set[tuple[int, int, int]]]):
        n = len(lat.spans)
        self.lat = lat
        offset = np.searchsorted(lat.region, np.arange(n + 1))
        self.steps = int(np.diff(offset).max(initial=0)) + 1           # ends in a token of type none
        kinds = np.where(lat.mail == 1, 1, 3)
        self.seg = np.repeat(np.arange(len(lat.i)), kinds)
        first = np.repeat(np.where(lat.mail == 1, 0, 1), kinds)
        self.kind = first + np.arange(len(self.seg)) - np.repeat(np.cumsum(kinds) - kinds, kinds)
        self.row = lat.region[lat.i[self.seg]]
        self.i, self.j = lat.i[self.seg] - offset[self.row], lat.j[self.seg] - offset[self.row]
        self.by_end, self.by_start = np.argsort(self.j, kind="stable"), np.argsort(self.i, kind="stable")
        steps = np.arange(self.steps + 2)
        self.ends, self.starts = np.searchsorted(self.j[self.by_end], steps), np.searchsorted(self.i[self.by_start], steps)
        where = {(*lat.found(s), k): a for a, (s, k) in enumerate(zip(self.seg, self.kind))}
        self.gold = np.zeros(len(self.seg))
        self.moves = np.zeros((5, 5))
        self.usable = np.ones(n, bool)
        for r, spans in enumerate(gold):
            arcs = [where.get((r, s, e, k)) for k, s, e in spans]
            if None in arcs:
                self.usable[r] = False
                continue
            self.gold[arcs] = 1
            at, state = 0, 0
            for a in sorted(arcs, key=lambda a: self.i[a]):
                if self.i[a] > at:
                    self.moves[state, 0] += 1
                    self.moves[0, 0] += self.i[a] - at - 1
                    state = 0
                self.moves[state, self.kind[a] + 1] += 1
                at, state = self.j[a], self.kind[a] + 1
            self.moves[state, 0] += 1
            self.moves[0, 0] += self.steps - at - 1
        self.live = self.usable[self.row]

    def value(self, weights: np.ndarray, moves: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """(log-likelihood, gradient of the weights, of the transitions)."""
        n, t_max, y = len(self.lat.spans), self.steps, self.kind + 1
        score = segment_scores(self.lat, weights)[self.seg, self.kind]
        ahead, back = np.full((n, t_max + 1, 5), -np.inf), np.full((n, t_max + 1, 5), -np.inf)
        ahead[:, 0, 0] = 0
        into = np.zeros(len(self.seg))
        for t in range(1, t_max + 1):
            ahead[:, t, 0] = log_sum(ahead[:, t - 1] + moves[:, 0])
            a = self.by_end[self.ends[t]:self.ends[t + 1]]
            if len(a):
                into[a] = log_sum(ahead[self.row[a], self.i[a]] + moves[:, y[a]].T) + score[a]
                np.logaddexp.at(ahead, (self.row[a], t, y[a]), into[a])
        z = ahead[:, t_max, 0]                                          # the last token is of type none
        back[:, t_max, 0] = 0
        for t in range(t_max - 1, -1, -1):
            back[:, t] = moves[:, 0] + back[:, t + 1, :1]
            a = self.by_start[self.starts[t]:self.starts[t + 1]]
            if len(a):
                out = score[a] + back[self.row[a], self.j[a], y[a]]
                np.logaddexp.at(back, (self.row[a], t), moves[:, y[a]].T + out[:, None])
        after = back[self.row, self.j, y]
        p = np.exp(into + after - z[self.row]) * self.live
        grad = np.zeros_like(weights)
        diff = (self.gold - p) * self.live
        for g in range(len(GROUPS)):
            np.add.at(grad, (self.lat.feats[self.seg, g], self.kind), diff)
        np.add.at(grad, (len(weights) - 1, self.kind), diff)
        use = self.usable[:, None, None]
        expected = np.zeros((5, 5))
        expected[:, 0] = (np.exp(ahead[:, :-1] + moves[:, 0] + back[:, 1:, :1] - z[:, None, None]) * use).sum((0, 1))
        step = np.exp(ahead[self.row, self.i] + moves[:, y].T + (score + after - z[self.row])[:, None]) * self.live[:, None]
        np.add.at(expected.T, y, step)
        total = (score * self.gold)[self.live].sum() + (moves * self.moves).sum() - z[self.usable].sum()
        change = self.moves - expected
        change[0, 0] = 0                                                # tokens outside score 0
        return float(total), grad, change


def fit(lat: Lattice, gold: list[set[tuple[int, int, int]]], rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions of largest penalised likelihood, by Adam over all regions."""
    weights, moves = empty_weights()
    fitted = Likelihood(lat, gold)
    if not fitted.live.any():
        weights[-1] = -1e3
        return weights, moves
    n = max(1, int(fitted.usable.sum()))
    state = [[x, np.zeros_like(x), np.zeros_like(x)] for x in (weights, moves)]
    for step in range(1, rounds + 1):
        _, *grads = fitted.value(state[0][0], state[1][0])
        rate = RATE * (1 - (step - 1) / rounds)
        for slot, g in zip(state, grads):
            g = g / n - RIDGE * slot[0] / 10
            slot[1] = 0.9 * slot[1] + 0.1 * g
            slot[2] = 0.99 * slot[2] + 0.01 * g * g
            slot[0] = slot[0] + rate * (slot[1] / (1 - 0.9 ** step)) / (np.sqrt(slot[2] / (1 - 0.99 ** step)) + 1e-8)
        state[1][0][0, 0] = 0
    weights, moves = state[0][0], state[1][0]
    seen = np.array([(fitted.kind[fitted.gold > 0] == k).any() for k in range(4)])
    weights[-1, ~seen] = -1e3                                           # nothing to learn this kind from
    return weights, moves


def decode(lat: Lattice, weights: np.ndarray, moves: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(region, kind, start, end) of the best segmentation of every region.

    A segment whose score stays negative with the best transitions around
    it cannot be in the best segmentation, so only the others are searched."""
    if not len(lat.i):
        return []
    score = segment_scores(lat, weights)
    lift = moves.max() - min(0.0, moves[:, 0].min()) + max(0.0, moves[:, 0].max())
    s_at, k_at = np.nonzero(score + lift > 0)
    order = np.argsort(lat.j[s_at], kind="stable")
    ends: dict[int, list[tuple[int, int, int, float]]] = {}
    for s, k in zip(s_at[order].tolist(), k_at[order].tolist()):
        ends.setdefault(int(lat.j[s]), []).append((int(lat.i[s]), s, k + 1, float(score[s, k])))
    out, m = [], moves.tolist()
    bounds = np.searchsorted(lat.region, np.arange(len(lat.spans) + 1)).tolist()
    busy = sorted({int(lat.region[lat.i[s]]) for s in s_at})
    for r in busy:
        lo, hi = bounds[r], bounds[r + 1]
        best = [[-np.inf] * 5 for _ in range(hi - lo + 2)]
        best[0][0] = 0.0
        come: dict = {}
        for t in range(lo + 1, hi + 2):                                  # one token of type none closes the region
            here, last = best[t - lo], best[t - lo - 1]
            y0 = max(range(5), key=lambda y: last[y] + m[y][0])
            here[0] = last[y0] + m[y0][0]
            come[t, 0] = (t - 1, y0, None)
            for i, s, y, v in ends.get(t, ()) if t <= hi else ():
                before = best[i - lo]
                y0 = max(range(5), key=lambda x: before[x] + m[x][y])
                if before[y0] + m[y0][y] + v > here[y]:
                    here[y] = before[y0] + m[y0][y] + v
                    come[t, y] = (i, y0, s)
        t, y, own = hi + 1, 0, []
        while t > lo:
            i, y0, s = come[t, y]
            if s is not None:
                own.append((r, y - 1, *lat.found(s)[1:]))
            t, y = i, y0
        out += own[::-1]
    return out


# ---------------------------------------------------------------- training passages
def passages(text: str) -> list[tuple[int, str]]:
    """(kind, passage) around each pattern span, and (4, passage) around digits
    without any nearby."""
    spans, out, taken = base_spans(text), [], []
    for kind, s, e in spans:
        lo, hi = max(0, s - BEFORE), min(len(text), e + AFTER)
        taken.append((lo, hi))
        out.append((kind, text[lo:hi]))
    for lo, hi in regions(text):
        if hi - lo <= 4 * BEFORE and not any(a < hi and lo < b for a, b in taken):
            out.append((4, text[lo:hi]))
    return out


def rewritten(kind: int, text: str, s: int, e: int) -> list[tuple[str, int, int, int | None]]:
    """The passage with the span in other forms: (text, start, end, kind), or
    kind None where the new form is no personal data."""
    own, before, after = text[s:e], text[:s], text[e:]
    digits = NOT_DIGIT.sub("", own)
    wrong = str((int(digits[-1]) + 1) % 10) if digits else ""
    if kind == EMAIL:
        name, host = own.split("@", 1)
        forms = [("", f"{name}{at}{host.replace('.', dot)}", kind)
                 for at, dot in ((" [at] ", " [dot] "), (" (at) ", "."), ("[at]", "[dot]"), (" @ ", "."), (" {at} ", " {dot} "))]
    elif kind == IP:
        parts = own.split(".")
        forms = [("", "[.]".join(parts), kind), ("", "(.)".join(parts), kind), ("", "[.]".join([*parts[:3], "9" + parts[3].zfill(3)]), None)]
    elif kind == CARD:
        quads = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        bad = digits[:-1] + wrong
        forms = [("", mark.join(quads), kind) for mark in (".", "/", " - ", "  ")]
        forms += [("card ", digits, kind), ("", bad, None), ("", ".".join(bad[i:i + 4] for i in range(0, len(bad), 4)), None)]
    else:
        plain = own.lstrip("+")
        forms = [("", "00" + plain, kind), ("phone: ", plain, kind), ("tel. ", plain, kind), ("call ", digits[-10:], kind),
                 ("", digits[-10:], None), ("order ", digits, None), ("", plain, None)]
    return [(before + cue + new + after, s + len(cue), s + len(cue) + len(new), k) for cue, new, k in forms]


def labelled(kept: list[tuple[int, str]]) -> tuple[list[tuple[str, int, int]], list[set[tuple[int, int, int]]]]:
    """Regions and their spans: the passages as they are, and rewritten."""
    spans, gold = [], []

    def add(text, own):
        spans.append((text, 0, len(text)))
        gold.append(own)

    for kind, text in kept:
        own = set()
        for k, s, e in base_spans(text):                                # of two that overlap the longer one
            clash = [x for x in own if x[1] < e and s < x[2]]
            if all(x[2] - x[1] < e - s for x in clash):
                own = (own - set(clash)) | {(k, s, e)}
        add(text, own)
        if kind < 4 and len(own) == 1:
            (k, s, e), = own
            for new, a, b, kk in rewritten(k, text, s, e):
                add(new, {(kk, a, b)} if kk is not None else set())
    return spans, gold


def train(docs: DataFrame, text_col: str = "text", per_kind: int = PER_KIND) -> tuple[np.ndarray, np.ndarray]:
    """The field, fitted on at most ``per_kind`` distinct passages a kind,
    those of smallest hash."""
    def find(batches):
        for pdf in batches:
            rows = [(k, p) for t in pdf["text"] for k, p in passages(t)]
            yield pd.DataFrame(rows, columns=["kind", "passage"])

    found = (docs.select(text_of(text_col).alias("text")).mapInPandas(find, "kind int, passage string")
                 .distinct().withColumn("h", F.xxhash64("passage")))
    first = Window.partitionBy("kind").orderBy("h", "passage")
    kept = (found.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= per_kind)
                 .orderBy("kind", "r").select("kind", "passage").collect())        # at most 5 * per_kind passages
    spans, gold = labelled([(r["kind"], r["passage"]) for r in kept])
    return fit(Lattice(spans), gold)


# ---------------------------------------------------------------- scanning
def added_spans(texts: list[str], based: list[list[tuple[int, int, int]]], weights: np.ndarray,
                moves: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) that the field adds to each text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    piece, size = [], 0

    def flush():
        lat = Lattice([(texts[t], lo, hi) for t, lo, hi in piece])
        for r, kind, s, e in decode(lat, weights, moves):
            t = piece[r][0]
            if not any(a < e and s < b for _, a, b in based[t]):
                out[t].append((kind, s, e))

    for t, text in enumerate(texts):
        for lo, hi in regions(text):
            piece.append((t, lo, hi))
            size += (hi - lo) // 2
            if size >= PIECE:
                flush()
                piece, size = [], 0
    if piece:
        flush()
    return out


SPANS = "array<struct<kind:int,start:long,end:long,base:boolean>>"


def scan(docs: DataFrame, model: tuple[np.ndarray, np.ndarray] | None = None, text_col: str = "text",
         out: str = "spans") -> DataFrame:
    """``docs`` with the column ``out``: spans (kind, start, end, base), by
    kind, then start; ``base`` marks those of the patterns."""
    weights, moves = model or train(docs, text_col)

    @F.pandas_udf(SPANS)
    def find(texts: pd.Series) -> pd.Series:
        listed = [t or "" for t in texts]
        based = [base_spans(t) for t in listed]
        more = added_spans(listed, based, weights, moves)
        return pd.Series([sorted([(*s, True) for s in b] + [(*s, False) for s in m]) for b, m in zip(based, more)])

    return docs.withColumn(out, find(text_of(text_col)))


def listed(spans) -> F.Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Per document: counts per kind, digest of the pattern spans, all spans."""
    found = scan(docs.select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, model: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets (spans
    that overlap by the first one's); ``n_chars``, where present, is the new length.
    Same columns; null texts stay null."""
    weights, moves = model or train(docs)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        given = [t or "" for t in texts]
        based = [base_spans(t) for t in given]
        out = []
        for t, b, m in zip(given, based, added_spans(given, based, weights, moves)):
            at, parts = 0, []
            for s, e, k in sorted((s, e, k) for k, s, e in b + m):
                if s >= at:
                    parts += [t[at:s], f"[{KINDS[k].upper()}]"]
                at = max(at, e)
            out.append("".join([*parts, t[at:]]))
        return pd.Series(out, dtype=object)

    text = F.when(F.col("text").isNotNull(), clean(F.col("text")))
    new = docs.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new = new.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return new.select(*[F.col(f"`{c}`") for c in docs.columns])


def digest(spans: list[tuple[int, int, int]]) -> str:
    """The contract's digest of (kind, start, end), for tests."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans)).encode()).hexdigest()
