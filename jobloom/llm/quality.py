"""Statistics of each document's text, and whether it is prose, a list, a table or junk.

The plain statistics are JVM expressions. The kind is decided by gradient-boosted
trees over statistics of the whole text, trained on documents whose layout alone
gives them away (weak labels) and on mixtures cut from them, with probabilities
calibrated on a small holdout that was labelled by hand.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("prose", "list", "table", "junk")
#: Documents the trees are trained on, at most; chosen by a hash of their id.
TRAINING_DOCUMENTS = 3_000
#: Texts mixed of two kinds the trees are trained on.
MIXTURES = 1_600
#: Characters a document of the training sample has at most, so that the sample's size is bounded.
TRAINING_LENGTH = 20_000

# Common words of English, German, French and Spanish.
COMMON = frozenset(
    (
        "the a an and of to in is are was for that with on at by from or as it you we our your this will be can not who how have "
        "der die das und ist sie wir ein eine einen zu den dem für mit auf im von nicht kann werden unser haben dass auch "
        "le les des et du dans pour nous vous est une un au aux avec sur qui que notre votre ce sont pas plus "
        "el la los las de en una y con para por es se lo su al nuestro como pero hay también muy"
    ).split()
)

# ---------------------------------------------------------------- statistics


def _nonblank_lines(text: Column) -> Column:
    return F.filter(F.split(text, r"\r?\n"), lambda line: F.length(F.trim(line)) > 0)


def text_statistics(documents: DataFrame) -> DataFrame:
    """One row per document: words, mean word length, shares of symbols, of ended lines and of common words.

    A word is a run of ASCII letters and digits or of letters beyond ASCII; a symbol is any character
    that is neither letter, digit nor white space. Null texts count as empty; shares
    of nothing are 0. Lines that hold only blanks aren't counted.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    low = F.lower(text)
    word = F.regexp_extract_all(low, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    n = F.size("w")
    lines = F.size("lines")
    share = lambda a, b: F.round(F.when(b > 0, a / b).otherwise(0.0), 4)
    base = documents.select("doc_id", text.alias("text"), word.alias("w"), _nonblank_lines(text).alias("lines"))
    symbols = F.length(F.regexp_replace("text", r"[\p{L}\p{N}\s\p{Z}]", ""))
    ended = F.size(F.filter("lines", lambda x: x.rlike(r"[.!?:;]\s*$")))
    return base.select(
        "doc_id",
        n.cast("bigint").alias("n_words"),
        share(F.aggregate("w", F.lit(0), lambda a, x: a + F.length(x)), n).alias("mean_word_length"),
        share(symbols, F.length("text")).alias("symbol_ratio"),
        share(ended, lines).alias("ended_lines"),
        share(F.size(F.filter("w", lambda x: x.isin(sorted(COMMON)))), n).alias("common_words"),
    )


# ---------------------------------------------------------------- layout

#: White space and characters that take no space.
_BLANK = " \t\r\n\v\f\u00a0\u200b\u200c\u200d\u2060\ufeff"
_TAG = re.compile(r"</?(?:p|br|div|span|b|i|em|strong|h[1-6]|section|article)\b[^>]*>", re.I)
_CELLS_TAG = re.compile(r"<(?:t[dhr]|table)\b", re.I)
_MARKER = re.compile(r"^(?:[-–—*•»▪◦‣·+☐☑✓]|\[[ xX]?\]|\(?\d{1,4}[.):]|\(?[a-zA-Z][.)]|<li>)\s*(?=\S)")
_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"\S+")
_ESCAPE = re.compile(r"\\u[0-9a-fA-F]{4}|%[0-9a-fA-F]{2}|&#x?[0-9a-fA-F]+;")
_MOJIBAKE = re.compile(r"[ÃÂâÐÑï][\u0080-¿€™‚¬“”‡¼½±§©¤°¿…œ‹›‘-‟]|�")
_DELIMITERS = ("\t", "|", "│", ";", ",", "  ")
_VOWELS = frozenset("aeiouyäöüáéíóúàèìòùâêîôûëïœæåø")
_RUN = re.compile(r"(\S)\1{3,}")


#: A full stop, a question or exclamation mark at a word's end.
_STOP = re.compile(r"[^\W\d_][.!?](?=[\s\"'”’)]|$)")


def _cells(line: str) -> tuple[str, int]:
    """The delimiter that cuts a line into most cells, and their number; ("", 1) if none does."""
    body = line.strip(" |│")
    best = ("", 1)
    for d in _DELIMITERS:
        if d == "  ":
            n = len(re.findall(r"\S(?=\s{2,}\S)", body)) + 1
        elif d == ",":
            n = len(re.findall(r",(?! )", body)) + 1
        else:
            n = body.count(d) + 1
        if n > best[1]:
            best = (d, n)
    return best


def _enumerated(line: str, words: int, common: float) -> bool:
    """Many short entries in one line. Entries of a few common words count where no sentence can hold the separator."""
    for sep, plain in ((r"\s/\s", True), (r"\s[|•·]\s", True), (r";\s", False), (r",\s", False)):
        parts = re.split(sep, line)
        if len(parts) >= 4 and words / len(parts) <= 4.5:
            if plain or common < 0.1 or len(parts) >= 5 and not _STOP.search(line[:-1]) and max(p.count(" ") for p in parts) <= 5:
                return True
    return False


def _vowels(letters: str) -> int:
    return sum(map(letters.count, _VOWELS))


def line_kind(line: str, words: list[str], common: float, sentences: bool, again: bool) -> str:
    """What a line is by itself: prose, list, junk, short or other.

    ``sentences``: its text has any; ``again``: the line occurs more than once.
    """
    n = len(line)
    joined = "".join(words).lower()
    letters = len(joined)
    marked = _MARKER.match(line)
    tokens = _TOKEN.findall(line)
    if letters < 0.35 * n and not (marked and re.search(r"\w", line[marked.end() :])):
        return "junk"
    if len(tokens) >= 10 and sum(len(t) == 2 for t in tokens) > 0.9 * len(tokens):
        return "junk"
    if len(words) >= 6 and len({w.lower() for w in words}) <= max(2, 0.2 * len(words)):
        return "junk"
    if ("%" in line or "\\u" in line or "&#" in line) and sum(map(len, _ESCAPE.findall(line))) > 0.4 * n:
        return "junk"
    if common < 0.15 or len(words) < 5:
        if len(_MOJIBAKE.findall(line)) * 2 > 0.3 * n or n > 30 and n / len(tokens) > 25:
            return "junk"
        if len(tokens) >= 6 and letters and _vowels(joined) < 0.2 * letters:
            return "junk"
    if marked and (len(words) <= 10 and line[-1] not in ".!?" or common < 0.15):
        return "list"
    if _enumerated(line, len(words), common):
        return "list"
    if common < 0.15 or len(words) < 5:
        return "short" if len(words) <= 8 else "prose" if common > 0.05 else "other"
    return "short" if not sentences and (len(words) <= 5 or again and len(words) <= 8) else "prose"


def kind_shares(text: str) -> dict[str, float]:
    """Shares of a text's characters by ``line_kind``, with tables and runs of entries told by neighbours; for weak labels only."""
    clean = html.unescape(text) if "&" in text else text
    if "<" in clean:
        clean = _TAG.sub("\n", clean)
    lines = [x for x in clean.split("\n") if x.strip(_BLANK)]
    words_of = [_WORD.findall(x) for x in lines]
    words = [w for ws in words_of for w in ws]
    low = [w.lower() for w in words]
    n = max(1, len(words))
    stops = len(_STOP.findall(clean))
    sentences = stops > 0.015 * n or len(lines) < 4
    chars = {"prose": 0, "list": 0, "table": 0, "junk": 0, "short": 0, "other": 0}
    info = []
    entries = Counter(map(tuple, words_of))
    for line, ws in zip(lines, words_of, strict=True):
        common = sum(w.lower() in COMMON for w in ws) / max(1, len(ws))
        kind = line_kind(line.strip(), ws, common, sentences, entries[tuple(ws)] > 1)
        info.append((kind, _cells(line) if kind != "prose" or common < 0.2 else ("", 1), len(ws)))
    for i, line in enumerate(lines):
        kind, (delimiter, cells), n_words = info[i]
        near = [info[j][1] for j in (i - 1, i + 1) if 0 <= j < len(lines)]
        # Cells are a table's only where the next or the last line has the same columns (an empty last cell allowed).
        if cells > 1 and any(d == delimiter and abs(c - cells) <= (cells > 2) for d, c in near) and n_words / cells <= 5:
            kind = "table"
        elif kind == "short" and delimiter in ("", "  ") and any(d == "  " and c > 2 for d, c in near):
            kind = "table"
        if "<t" in line and _CELLS_TAG.search(line):
            kind = "table"
        chars[kind] += len(line.strip())
    # Unmarked short lines in a row are entries where the text has no sentences; alone they are headings.
    run = sum(len(lines[i].strip()) for i in range(len(lines)) if info[i][0] == "short" and sum(info[j][0] == "short" for j in (i - 1, i + 1) if 0 <= j < len(lines)))
    run = min(run, chars["short"])
    if not sentences:
        chars["list"] += run
        chars["short"] -= run
    # Markup around nothing is junk.
    visible = sum(chars.values())
    if len(text) > 30 and visible < 0.15 * len(text):
        chars = dict.fromkeys(chars, 0) | {"junk": len(text)}
    total = max(1, sum(chars.values()))
    return {k: n / total for k, n in chars.items()} | {"common": sum(w in COMMON for w in low) / n}


#: What is counted of a line, as shares of all characters.
LINE_STATISTICS = 14


def shape(text: str) -> np.ndarray:
    """Statistics of a whole text, as the trees see them: plain counts, and shares of the characters in lines with a plain property."""
    clean = html.unescape(text) if "&" in text else text
    if "<" in clean:
        clean = _TAG.sub("\n", clean)
    lines = [x.strip() for x in clean.split("\n") if x.strip(_BLANK)]
    cells = [_cells(x) for x in lines]
    sums = np.zeros(LINE_STATISTICS)
    total = letters_all = words_all = common_all = vowels_all = 0
    different: set[str] = set()
    for i, line in enumerate(lines):
        words = _WORD.findall(line.lower())
        tokens = line.split()
        size, n = len(line), len(words)
        letters = sum(map(len, words))
        common = sum(map(COMMON.__contains__, words))
        vowels = _vowels("".join(words))
        delimiter, k = cells[i]
        near = k > 1 and any(d == delimiter and abs(c - k) <= (k > 2) for d, c in cells[max(0, i - 1) : i] + cells[i + 1 : i + 2])
        separators = max(line.count(" / "), line.count(" | "), line.count(" • "), line.count(" · "), line.count("; "), line.count(", "))
        marked = bool(_MARKER.match(line))
        values = (
            marked,
            line[-1] in ".!?",
            n >= 8 and common >= 0.15 * n,
            common >= 0.15 * n and n >= 5,
            n <= 5,
            near and n <= 5 * k,
            letters < 0.35 * size,
            n >= 6 and len(set(words)) <= max(2, 0.2 * n),
            n >= 6 and letters and vowels < 0.2 * letters,
            size > 30 and size > 25 * len(tokens),
            separators >= 3 and n <= 4.5 * (separators + 1),
            marked and n <= 10 and line[-1] not in ".!?",
            common < 0.1 * n or not n,
            "<t" in line and bool(_CELLS_TAG.search(line)),
        )
        sums += np.array(values, dtype=np.float64) * size
        total += size
        letters_all, words_all, common_all, vowels_all = letters_all + letters, words_all + n, common_all + common, vowels_all + vowels
        different.update(words)
    tokens = clean.split()
    lengths = list(map(len, tokens))
    solid, n = max(1, sum(lengths)), max(1, words_all)
    escapes = sum(map(len, _ESCAPE.findall(text))) if "%" in text or "\\u" in text or "&#" in text else 0
    broken = 0 if clean.isascii() else 2 * len(_MOJIBAKE.findall(clean))
    stops = len(_STOP.findall(clean))
    return np.array(
        [
            *(sums / max(1, total)),
            common_all / n,
            letters_all / solid,
            sum(map(clean.count, "0123456789")) / solid,
            len(different) / n,
            letters_all / n,
            vowels_all / max(1, letters_all),
            min(200.0, total / max(1, len(lines))),
            sum(map(len, (m.group(0) for m in _RUN.finditer(clean)))) / solid,
            min(60.0, solid / max(1, len(tokens))),
            stops / n,
            escapes / max(1, len(text)),
            broken / solid,
            min(1.0, total / max(1, len(text))),
            lengths.count(2) / max(1, len(tokens)),
            stops / max(1, len(lines)),
            float(len(lines) < 4),
        ],
        dtype=np.float64,
    )


def weak_label(text: str) -> int:
    """The kind of a document whose layout alone gives it away, else -1."""
    x = kind_shares(text)
    if x["prose"] >= 0.8 and x["common"] >= 0.15:
        return 0
    if x["list"] >= 0.85 and x["table"] < 0.1 and x["junk"] < 0.1:
        return 1
    if x["table"] >= 0.8:
        return 2
    if x["junk"] >= 0.8:
        return 3
    return -1


# ---------------------------------------------------------------- trees


class Boosted:
    """Gradient-boosted trees with a softmax over KINDS, on binned features."""

    def __init__(self, rounds: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 32) -> None:
        self.rounds, self.depth, self.rate, self.bins = rounds, depth, rate, bins
        self.trees: list[list[list[tuple]]] = []
        self.temperature = 1.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)], axis=1)
        scores = np.zeros((len(x), len(KINDS)))
        target = np.eye(len(KINDS))[y]
        for _ in range(self.rounds):
            p = np.exp(scores - scores.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            round_ = []
            for k in range(len(KINDS)):
                g, h = target[:, k] - p[:, k], np.maximum(p[:, k] * (1 - p[:, k]), 1e-6)
                tree: list[tuple] = []
                self._grow(tree, binned, edges, g, h, np.arange(len(x)), 0)
                round_.append(tree)
                scores[:, k] += self.rate * self._leaf(tree, x)
            self.trees.append(round_)
        return self

    def _grow(self, tree: list[tuple], binned: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, at: np.ndarray, depth: int) -> int:
        node = len(tree)
        total_g, total_h = g[at].sum(), h[at].sum()
        tree.append((-1, 0.0, total_g / (total_h + 1.0), 0, 0))
        if depth == self.depth or len(at) < 10:
            return node
        best = (1e-3, -1, 0)
        for j, e in enumerate(edges):
            if not len(e):
                continue
            left_g = np.cumsum(np.bincount(binned[at, j], g[at], len(e) + 1))[:-1]
            left_h = np.cumsum(np.bincount(binned[at, j], h[at], len(e) + 1))[:-1]
            gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
            b = int(gain.argmax())
            if gain[b] > best[0]:
                best = (float(gain[b]), j, b)
        if best[1] >= 0:
            _, j, b = best
            goes = binned[at, j] <= b
            value = tree[node][2]
            left = self._grow(tree, binned, edges, g, h, at[goes], depth + 1)
            right = self._grow(tree, binned, edges, g, h, at[~goes], depth + 1)
            tree[node] = (j, float(edges[j][b]), value, left, right)
        return node

    @staticmethod
    def _leaf(tree: list[tuple], x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        stack = [(0, np.arange(len(x)))]
        while stack:
            node, at = stack.pop()
            j, edge, value, left, right = tree[node]
            if j < 0:
                out[at] = value
            else:
                goes = x[at, j] < edge
                stack += [(left, at[goes]), (right, at[~goes])]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(KINDS)))
        for round_ in self.trees:
            for k, tree in enumerate(round_):
                out[:, k] += self.rate * self._leaf(tree, x)
        return out

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        """The temperature under which the holdout is likeliest."""
        s = self.scores(x)

        def loss(t: float) -> float:
            z = s / t
            return float((np.log(np.exp(z - z.max(1, keepdims=True)).sum(1)) + z.max(1) - z[np.arange(len(y)), y]).mean())

        self.temperature = min((float(t) for t in np.geomspace(0.25, 8, 41)), key=loss)
        return self

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = self.scores(x) / self.temperature
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


# The holdout: written and labelled by hand.
HOLDOUT = (
    ("Our team keeps its notes in the open, and everyone reads them before the weekly call. We would like to hear from you.", 0),
    ("we are looking for a person who likes to fix things and who can explain them to others the office is near the station", 0),
    ("THE BUDGET WAS APPROVED IN MAY.\nTHE WORK CAN START AT ONCE.\nNOBODY WORKS ALONE HERE.", 0),
    ("Wir suchen eine Person, die gern mit Zahlen arbeitet.\n\nDie Stelle ist unbefristet und kann zum Teil von zu Hause ausgeübt werden.", 0),
    ("Nous cherchons une personne qui aime apprendre. Vous travaillez avec une équipe de huit personnes.\n- SQL\n- Java", 0),
    ("Buscamos una persona para nuestro equipo de datos. La jornada es flexible y se puede trabajar desde casa.", 0),
    ("<p>Candidates often ask about pay.</p><p>It depends on the role and on how long you have done it.</p>", 0),
    ("Overview\n\nTwo boards list the same opening, but only\none of them names the city. We could not\nresolve the page, so the record went to\nmanual review.", 0),
    ("- SQL\n- Python\n- Git\n- Excel", 1),
    ("Skills\n1. Java (2)\n2. Rust\n3. Go\n4. Kafka", 1),
    ("Hamburg\nLyon\nMadrid\nOslo (3)\nTurin", 1),
    ("Data Analyst / Tax Accountant / Scrum Master (4) / Copywriter / Legal Counsel", 1),
    ("Paris, Rome, Lisbon (2), Vienna, Prague, Dublin, Riga", 1),
    ("» dental cover;\n» flexible hours (2);\n» a yearly learning budget;\n» a home office stipend;", 1),
    ("[ ] Accountant\n[ ] Baker (7)\n[x] Carpenter\n[ ] Driver", 1),
    ("Requirements\n• shape the pricing engine\n• rebuild the returns desk (3)\n• own the mobile client", 1),
    ("role,city,rows\nAccountant,Lyon,12\nBaker,Rome,\nDriver,Oslo,44", 2),
    ("week\tsent\topened\nW1\t10\t4\nW2\t12\t7\nW3\t9\t1", 2),
    ("| name | place |\n| --- | --- |\n| Ann | Rome |\n| Bob | Oslo |", 2),
    ("board       provider   jobs\nclaims      lever      12\nfleet       ashby      7\nsearch      lever", 2),
    ("│ Stelle │ Ort │\n│ Koch │ Bonn │\n│ Arzt │ Köln │", 2),
    ("<table><tr><td>a</td><td>1</td></tr>\n<tr><td>b</td><td>2</td></tr></table>", 2),
    ("Table 3\n\nAnalyst;Lyon;12;4\nBaker;Rome;3;\nDriver;Oslo;44;1", 2),
    ("claims;lever;452\npartner;ashby;2458\nfleet;lever;3437", 2),
    ("====== ######## ;;;;;; !!!!!! ////// %%%%%%", 3),
    ("q9XkP2mZ7LrT0vWc4BnY8sHd1FgJ5aEe3UiO6tRwKxMzNpQbVl", 3),
    ("test test test test test test test test test test", 3),
    ("9e f4 ce b9 ee 4f 64 13 76 28 dc a0 5e bc 4b 55", 3),
    ("%A1%C4%44\\u00a8\\u0081%40%DC\\u0060%6B\\u00b7", 3),
    ("xkjd qwrt zzpl fghj kkrw mnbv trrq wsdf plkj", 3),
    ("48 9917 2 55031 7 120 8871 64 3 90210 5 77 1204", 3),
    ("■ ◆□ ▒ ✗ ●● ░ ¤ ✓ ◇□ ■ ▓", 3),
)


def train(texts: list[str], seed: int = 7) -> Boosted:
    """Trees from unlabelled texts: those their layout gives away, those of every other hand-labelled text, and mixtures cut from them.

    The other half of the hand-labelled texts is for calibration only.
    """
    rng = np.random.default_rng(seed)
    pure: dict[int, list[str]] = {k: [] for k in range(len(KINDS))}
    xs, ys = [], []
    for text in [*texts, *(t for t, _ in HOLDOUT[::2])]:
        k = weak_label(text)
        if k >= 0:
            pure[k].append(text)
            xs.append(shape(text))
            ys.append(k)
    filled = [k for k in pure if pure[k]]
    # Mixtures of prose and something else: the larger part in characters gives the label.
    for _ in range(MIXTURES):
        a, b = (0, int(rng.choice([k for k in filled if k])))
        first, second = (pure[k][int(rng.integers(len(pure[k])))] for k in (a, b))
        cut = int(len(second) * rng.uniform(0.2, 1.0))
        other = second[: max(second.rfind("\n", 0, cut), 0) or cut]
        size = len(other) * float(rng.choice([rng.uniform(0.3, 0.85), rng.uniform(1.2, 3.0)]))
        kept = first[: int(size)]
        if len(kept) > 0.9 * size:
            parts = [kept, other] if rng.random() < 0.5 else [other, kept]
            xs.append(shape("\n\n".join(parts)))
            ys.append(a if len(kept) > len(other) else b)
    held = HOLDOUT[1::2]
    held_x, held_y = np.stack([shape(t) for t, _ in held]), np.array([k for _, k in held])
    return Boosted().fit(np.stack(xs), np.array(ys)).calibrate(held_x, held_y)


def document_kinds(documents: DataFrame) -> DataFrame:
    """``doc_id, kind, probability`` of every text that isn't null or blank; kind is one of KINDS.

    The trees are trained on at most TRAINING_DOCUMENTS texts; every text is
    classified, whole, in one narrow stage.
    """
    full = documents.select("doc_id", "text").filter(F.col("text").rlike(r"[^\s\p{Z}]"))
    short = full.filter(F.length("text") <= TRAINING_LENGTH)
    sample = [r["text"] for r in short.orderBy(F.xxhash64("doc_id")).limit(TRAINING_DOCUMENTS).select("text").collect()]
    model = train(sample)
    key_type = documents.schema["doc_id"].dataType.simpleString()

    def classify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                p = model.probabilities(np.stack([shape(t) for t in batch["text"]]))
                best = p.argmax(1)
                yield pd.DataFrame({"doc_id": batch["doc_id"], "kind": [KINDS[k] for k in best], "probability": p[np.arange(len(p)), best]})

    return full.mapInPandas(classify, f"doc_id {key_type}, kind string, probability double")


def not_prose(documents: DataFrame) -> DataFrame:
    """``doc_id, kind`` of the documents that aren't natural prose."""
    return document_kinds(documents).filter("kind <> 'prose'").select("doc_id", "kind")
