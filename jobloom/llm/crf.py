"""A linear-chain conditional random field over word shapes, in numpy.

A token's features depend on its string only, so the scores a string gives to
the labels of its own place and of the places around it are computed once per
different string; a text's scores are sums of table rows. Sequences are trained
and decoded in batches: one step of forward-backward or Viterbi serves all of them.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Sequence

import numpy as np

#: Places, counted from a token, whose features count for its label.
OFFSETS = (0, -1, 1, -2, 2, -3)
REACH = 3

TOKEN = re.compile(r"[\w.+-]*\w@\w[\w.-]*\w|\w+(?:[._'’+-]+\w+)*|\n+|[^\w\s]")


def fold(text: str) -> str:
    if text.isascii():
        return text.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def shape(token: str) -> str:
    """Capitals X, small letters x, digits d; runs of letters shortened, the number of digits kept. Addresses have one shape each."""
    if "@" in token[1:-1]:
        return "address"
    if not token.isalpha() and re.fullmatch(r"[^\W\d]+(?:[._+-]+\w+)+", token) and re.search(r"[._+]", token):
        return "dotted" if re.fullmatch(r"[a-zA-Z]+(?:\.[a-zA-Z]{2,})+", token) else "user"
    s = "".join("d" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c for c in token)
    return re.sub(r"d{16,}", "d+", re.sub(r"x{2,}", "x+", re.sub(r"X{2,}", "X+", s)))


#: Ends a token whose own string is hidden from training.
HIDDEN = "\0"


def hidden(token: str) -> str:
    return token + HIDDEN


def letter_cases(vocabulary: str) -> dict[str, str]:
    """How a word (its key is in small letters) is mostly written, by a public byte-level vocabulary.

    Tokens that are a whole word are ranked by how usual they are: ``small`` where the
    word in small letters comes before the capitalised one, else ``proper``.
    """
    ranks: dict[str, tuple[int, bool]] = {}
    with open(vocabulary, "rb") as f:
        for line in f:
            token, rank = line.split()
            try:
                word = base64.b64decode(token).decode("utf-8")
            except UnicodeDecodeError:
                continue
            if word[:1] == " " and word[1:].isalpha() and (word[1:].islower() or word[1:].istitle()):
                key = fold(word[1:])
                if key not in ranks or int(rank) < ranks[key][0]:
                    ranks[key] = (int(rank), word[1:].islower())
    return {w: "small" if small else "proper" for w, (_, small) in ranks.items()}


def features(token: str, cases: dict[str, str]) -> tuple[list[str], list[str], str]:
    """(features for the token's own place, those for the places around it, the feature of its string, "" if hidden).

    A string that isn't known counts as unknown, with its form.
    """
    shown = token[-1] != HIDDEN
    token = token if shown else token[:-1]
    if token[0] == "\n":
        return ["nl"], ["nl"], ""
    form = "s=" + shape(token)
    if form in ("s=address", "s=dotted", "s=user"):
        return ["b", form], [form], ""
    low = fold(token)
    word = "w=" + re.sub(r"\d", "0", low) if shown else ""
    own = ["b", form]
    near = [form]
    if token.isalpha():
        written = "v=" + cases.get(low, "rare") + form[2:4]
        own.append(written)
        near.append(written)
    if token.isalpha() and not shown:
        own += ["2>" + low[-2:], "n=" + str(min(len(low), 12))]
    elif token.isalpha():
        own += ["3<" + low[:3], "2>" + low[-2:], "3>" + low[-3:], "4>" + low[-4:], "5>" + low[-5:], "n=" + str(min(len(low), 12))]
    elif "-" in token and not any(c.isdigit() for c in token):
        own += ["4>" + low[-4:], "5>" + low[-5:], "h4>" + low.split("-")[0][-4:]]
    else:
        own += ["d=" + str(min(sum(c.isdigit() for c in token), 12)), "k=" + "".join(sorted(set(re.sub(r"\w", "", token))))]
    return own, near, word


#: A word is a feature of its own only if the labelled texts hold it so many times; affixes so many different words.
WORD_COUNT, TYPE_COUNT = 6, 2


def minimized(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking."""
    value, g = loss(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        q = g.copy()
        kept = []
        for s, y in reversed(pairs):
            r = (s @ q) / (y @ s)
            kept.append(r)
            q -= r * y
        if pairs:
            s, y = pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, float(np.linalg.norm(g)))
        for (s, y), r in zip(pairs, reversed(kept), strict=True):
            q += (r - (y @ q) / (y @ s)) * s
        rate, slope = 1.0, -(g @ q)
        while True:
            new_value, new_g = loss(x - rate * q)
            if new_value <= value + 1e-4 * rate * slope or rate < 1e-4:
                break
            rate *= 0.5
        step, change = -rate * q, new_g - g
        if abs(value - new_value) < 1e-5 * abs(value):
            return x + step
        if step @ change > 1e-10:
            pairs = [*pairs[1 - memory :], (step, change)]
        x, value, g = x + step, new_value, new_g
    return x


class _Sums:
    """Sums over the features of each type, and over the types of each feature."""

    def __init__(self, pairs: list[tuple[int, int]], types: int, features: int) -> None:
        self.types, self.features = types, features
        array = np.array(pairs)
        self.by_type = array[np.argsort(array[:, 0], kind="stable")]
        self.by_feature = array[np.argsort(array[:, 1], kind="stable")]
        self.type_at, self.type_start = np.unique(self.by_type[:, 0], return_index=True)
        self.feature_at, self.feature_start = np.unique(self.by_feature[:, 1], return_index=True)

    def rows(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros((self.types, weights.shape[1]), dtype=weights.dtype)
        out[self.type_at] = np.add.reduceat(weights[self.by_type[:, 1]], self.type_start, axis=0)
        return out

    def columns(self, by_type: np.ndarray) -> np.ndarray:
        out = np.zeros((self.features, by_type.shape[1]), dtype=by_type.dtype)
        out[self.feature_at] = np.add.reduceat(by_type[self.by_feature[:, 0]], self.feature_start, axis=0)
        return out


class Crf:
    """Weights for labels; ``transitions[a, b]`` scores label b after label a."""

    def __init__(self, labels: Sequence[str], cases: dict[str, str] | None = None) -> None:
        self.labels = list(labels)
        self.cases = cases or {}
        self.known: dict[str, int] = {}
        k = len(self.labels)
        self.weights = np.zeros((len(OFFSETS), 0, k), dtype=np.float32)
        self.transitions = np.zeros((k, k), dtype=np.float32)
        #: Labels come as one that begins nothing, then a first and an inner label per kind; an inner one follows its own kind only.
        self.possible = np.ones((k, k), dtype=bool)
        for j in range(2, k, 2):
            self.possible[:, j] = False
            self.possible[[j - 1, j], j] = True

    # -- training

    def fit(self, sequences: list[tuple[list[str], list[int]]], steps: int = 80, ridge: float = 0.5) -> Crf:
        k = len(self.labels)
        types = sorted({t for tokens, _ in sequences for t in tokens})
        number = {t: i + 1 for i, t in enumerate(types)}
        times = Counter(t for tokens, _ in sequences for t in tokens)
        per_type = [features(t, self.cases) for t in types]
        in_types: Counter[str] = Counter()
        in_texts: Counter[str] = Counter()
        for t, (own, near, word) in zip(types, per_type, strict=True):
            every = {*own, *near, "?" + near[0], *([word] if word else [])}
            in_types.update(every)
            for f in every:
                in_texts[f] += times[t]
        usual = [f for f in in_types if in_texts[f] >= WORD_COUNT and (f[:2] == "w=" or in_types[f] >= TYPE_COUNT or len(f) < 4)]
        self.known = {f: i for i, f in enumerate(sorted({*usual, "nl", "s=address", "s=dotted", "s=user"}))}
        own = _Sums([(i + 1, f) for i, t in enumerate(types) for f in self._known(t)[0]], len(types) + 1, len(self.known))
        near = _Sums([(i + 1, f) for i, t in enumerate(types) for f in self._known(t)[1]], len(types) + 1, len(self.known))
        # Places are laid out step by step, longest sequence first: those alive at a step are a run.
        ordered = sorted(sequences, key=lambda s: -len(s[0]))
        lengths = np.array([len(tokens) for tokens, _ in ordered])
        live = [int((lengths > t).sum()) for t in range(int(lengths[0]))]
        x = np.zeros((len(ordered), len(live) + 2 * REACH), dtype=np.int64)  # empty places at both ends
        y = np.zeros((len(ordered), len(live)), dtype=np.int64)
        for r, (tokens, labels) in enumerate(ordered):
            x[r, REACH : REACH + len(tokens)] = [number[t] for t in tokens]
            y[r, : len(labels)] = labels
        ids = [np.concatenate([x[:n, REACH + t + o] for t, n in enumerate(live)]) for o in OFFSETS]
        gold = np.concatenate([y[:n, t] for t, n in enumerate(live)])
        gold_pairs = np.zeros((k, k))
        for t, n in enumerate(live[1:], 1):
            np.add.at(gold_pairs, (y[:n, t - 1], y[:n, t]), 1)
        size = len(OFFSETS) * len(self.known) * k
        places = np.arange(len(gold))
        never = np.where(self.possible, 0.0, -60.0)

        def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
            """Regularised negative log-likelihood and its gradient."""
            weights, trans = theta[:size].reshape(len(OFFSETS), len(self.known), k).astype(np.float32), theta[size:].reshape(k, k) + never
            scores = np.zeros((len(gold), k), dtype=np.float32)
            for o, offset in enumerate(OFFSETS):
                scores += (near if offset else own).rows(weights[o])[ids[o]]
            node, edge, partition = self._expected(scores, trans.astype(np.float32), live)
            value = partition - float(scores[places, gold].sum(dtype=np.float64)) - float((trans * gold_pairs).sum()) + ridge * float(theta @ theta)
            node[places, gold] -= 1
            gradient = np.zeros((len(OFFSETS), len(self.known), k))
            for o, offset in enumerate(OFFSETS):
                by_type = np.stack([np.bincount(ids[o], node[:, j], len(types) + 1) for j in range(k)], axis=1)
                gradient[o] = (near if offset else own).columns(by_type)
            return value, np.concatenate([gradient.ravel(), (edge - gold_pairs).ravel()]) + 2 * ridge * theta

        theta = minimized(loss, np.zeros(size + k * k), steps)
        self.weights = theta[:size].reshape(len(OFFSETS), len(self.known), k).astype(np.float32)
        self.transitions = (theta[size:].reshape(k, k) + never).astype(np.float32)
        return self

    @staticmethod
    def _expected(scores: np.ndarray, trans: np.ndarray, live: list[int]) -> tuple[np.ndarray, np.ndarray, float]:
        """Label and label-pair expectations and the log partition, by scaled forward-backward over all sequences at once."""
        top = scores.max(1, keepdims=True)
        psi, a = np.exp(scores - top), np.exp(trans)
        starts = np.concatenate([[0], np.cumsum(live)])
        alpha = np.zeros_like(psi)
        partition = float(top.sum(dtype=np.float64))
        for t, n in enumerate(live):
            here = slice(starts[t], starts[t] + n)
            step = psi[here] if t == 0 else (alpha[starts[t - 1] : starts[t - 1] + n] @ a) * psi[here]
            scale = step.sum(1, keepdims=True)
            partition += float(np.log(scale).sum(dtype=np.float64))
            alpha[here] = step / scale
        beta = np.ones((live[0], len(a)), dtype=np.float32)
        node, edge = np.empty_like(psi), np.zeros_like(a, dtype=np.float64)
        for t in range(len(live) - 1, -1, -1):
            n = live[t]
            here = slice(starts[t], starts[t] + n)
            p = alpha[here] * beta[:n]
            node[here] = p / p.sum(1, keepdims=True)
            if t:
                inner = psi[here] * beta[:n]
                last = alpha[starts[t - 1] : starts[t - 1] + n]
                z = ((last @ a) * inner).sum(1, keepdims=True)
                edge += a * ((last / z).T @ inner)
                back = inner @ a.T
                beta[:n] = back / back.sum(1, keepdims=True)
        return node, edge, partition

    def _known(self, token: str) -> tuple[list[int], list[int]]:
        """Numbers of a token's features at its own place and around it; unknown strings share one feature per form."""
        own, near, word = features(token, self.cases)
        string = [] if near[0] in ("nl", "s=address", "s=dotted", "s=user") else [word if word in self.known else "?" + near[0]]
        known = self.known
        return [known[f] for f in own + string if f in known], [known[f] for f in near + string if f in known]

    # -- decoding

    def rows(self, token: str) -> np.ndarray:
        """What a token adds to the scores at its own place and at those around it."""
        own_ids, near_ids = self._known(token)
        out = np.zeros((len(OFFSETS), len(self.labels)), dtype=np.float32)
        for o, offset in enumerate(OFFSETS):
            ids = near_ids if offset else own_ids
            if ids:
                out[o] = self.weights[o, ids].sum(0)
        return out

    def viterbi(self, windows: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each window of scores, all windows of a batch step by step."""
        order = np.argsort([-len(w) for w in windows], kind="stable")
        lengths = np.array([len(windows[i]) for i in order])
        width, k = int(lengths[0]), len(self.labels)
        scores = np.zeros((len(windows), width, k), dtype=np.float32)
        for r, i in enumerate(order):
            scores[r, : lengths[r]] = windows[i]
        best = scores[:, 0].copy()
        back = np.zeros((len(windows), width, k), dtype=np.int8)
        trans = self.transitions
        inner = np.arange(2, k, 2)
        first = np.concatenate([[0], inner - 1])
        enter, begun, kept = np.ascontiguousarray(trans[:, first].T), trans[inner - 1, inner], trans[inner, inner]
        for t in range(1, width):
            live = int((lengths > t).sum())
            last = best[:live]
            new = np.empty_like(last)
            options = last[:, None, :] + enter[None]
            from_ = options.argmax(2)
            back[:live, t, first] = from_
            new[:, first] = np.take_along_axis(options, from_[:, :, None], 2)[:, :, 0]
            started, going = last[:, inner - 1] + begun, last[:, inner] + kept
            back[:live, t, inner] = np.where(going > started, inner, inner - 1)
            new[:, inner] = np.maximum(going, started)
            best[:live] = new + scores[:live, t]
        out: list[np.ndarray] = [np.empty(0, dtype=np.int8)] * len(windows)
        at = best.argmax(1)
        path = np.zeros((len(windows), width), dtype=np.int8)
        rows = np.arange(len(windows))
        for t in range(width - 1, -1, -1):
            inside = lengths > t
            path[inside, t] = at[inside]
            if t:
                at = np.where(inside, back[rows, t, at], at)
        for r, i in enumerate(order):
            out[i] = path[r, : lengths[r]]
        return out


class Tagger:
    """Decodes texts with a trained field; remembers the scores of the strings it met."""

    #: Different tokens remembered; the table is emptied when full.
    KEPT = 200_000
    #: Places on both sides of a promising token that are decoded with it.
    MARGIN = 12

    def __init__(self, crf: Crf) -> None:
        self.crf = crf
        over = crf.transitions - crf.transitions[0, 0]
        #: What the best transition into each label adds, and the best one back to the first label, if that gains.
        self.entry, self.exit = over.max(0)[1:], float(max(0.0, over[1:, 0].max()))
        self._empty()

    def _empty(self) -> None:
        self.number: dict[str, int] = {}
        self.table = np.zeros((4096, len(OFFSETS), len(self.crf.labels)), dtype=np.float32)

    def _ids(self, tokens: list[str]) -> list[int]:
        number = self.number
        for t in set(tokens).difference(number):
            i = len(number) + 1  # 0: no token
            if i == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            number[t] = i
            self.table[i] = self.crf.rows(t)
        return list(map(number.__getitem__, tokens))

    def tag(self, texts: Sequence[str | None]) -> list[list[tuple[int, np.ndarray]]]:
        """For each text, (place of the first token, labels) of the stretches that hold a label other than the first.

        A stretch is left out only if no labelling of it can beat the plain one: a run
        of other labels gains at most what its tokens gain over the first label, each
        with the best transition into its label, and the transition back.
        """
        if len(self.number) > self.KEPT:
            self._empty()
        lists = [TOKEN.findall(t) if t else [] for t in texts]
        flat: list[int] = []
        starts = []
        for tokens in lists:
            flat += (0,) * REACH
            starts.append(len(flat))
            flat += self._ids(tokens)
        flat += (0,) * REACH
        ids = np.array(flat, dtype=np.int64)
        n = len(ids)
        scores = self.table[ids, 0]
        for o, offset in enumerate(OFFSETS[1:], 1):
            part = self.table[ids, o]
            if offset < 0:
                scores[-offset:] += part[:offset]
            else:
                scores[:-offset] += part[offset:]
        promising = ((scores[:, 1:] + self.entry).max(1) - scores[:, 0] > -self.exit) & (ids > 0)
        places = np.flatnonzero(promising)
        out: list[list[tuple[int, np.ndarray]]] = [[] for _ in texts]
        if not len(places):
            return out
        begins = np.array(starts)
        ends = begins + np.array([len(t) for t in lists])
        text_of = np.searchsorted(begins, places, side="right") - 1
        low = np.maximum(places - self.MARGIN, begins[text_of])
        high = np.minimum(places + self.MARGIN + 1, ends[text_of])
        # Stretches of one text that touch are one.
        new = np.r_[True, (low[1:] > high[:-1]) | (text_of[1:] != text_of[:-1])]
        first = np.flatnonzero(new)
        lows, owners = low[first], text_of[first]
        highs = np.maximum.reduceat(high, first)
        windows = [scores[a:b] for a, b in zip(lows, highs, strict=True)]
        for at in range(0, len(windows), 4096):
            for j, labels in enumerate(self.crf.viterbi(windows[at : at + 4096]), at):
                if labels.any():
                    text = int(owners[j])
                    out[text].append((int(lows[j] - begins[text]), labels))
        return out
