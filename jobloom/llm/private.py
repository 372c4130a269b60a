"""Private values of people in free text: found by a tagger, replaced by typed placeholders."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm import private_table as table
from jobloom.llm.crf import TOKEN, Crf, Tagger, fold, hidden, letter_cases
from jobloom.llm.encoding import TOKENIZERS

#: Label 0 is no value; a kind has a label for its first token and one for the others, names have such a pair per letter case:
#: the parts of one name are written alike.
LABELS = ["O", *(f"{p}-{k}" for k in (*table.KINDS, "person_name small", "person_name capital") for p in "BI")]
KIND_OF = (*range(len(table.KINDS)), 4, 4)
#: Public vocabulary that tells words usually written small from proper names.
CASES_VOCABULARY = "byte_bpe_50k.tiktoken"
#: Labelled texts the field is trained on, made from the labelled table.
TRAINING_TEXTS = 6_000
#: Share of the training words whose own string is hidden, so that the field learns to judge unknown words by form and place.
HIDDEN = 0.4
#: Share of the training names made up of syllables.
INVENTED = 0.55


def _filled(pattern: str, rng: np.random.Generator) -> str:
    out = re.sub(r"#", lambda _: str(rng.integers(10)), pattern)
    return re.sub(r"\^", lambda _: "ABCDEFGHJKLMNPRTXYZ"[rng.integers(19)], out)


def _one(values: str, rng: np.random.Generator) -> str:
    options = [v.strip() for v in re.split(r"[|\n]", values)] if "|" in values else values.split()
    return options[rng.integers(len(options))]


def _invented(rng: np.random.Generator) -> str:
    """A word of two or three syllables that no language has to know."""
    heads, vowels, tails = "b|br|c|ch|d|f|fr|g|gr|h|j|k|kl|l|m|n|p|pr|qu|r|s|sh|st|t|th|tr|v|w|y|z".split("|"), "a|e|i|o|u|ai|ea|ou".split("|"), "||n|r|l|s|ck|nd|rt|ng|m|x|ld|ss".split("|")
    pick = lambda options: options[rng.integers(len(options))]
    return "".join(pick(heads) + pick(vowels) + (pick(tails) if rng.random() < 0.6 else "") for _ in range(2 + int(rng.random() < 0.4))).capitalize()


def _names(rng: np.random.Generator) -> tuple[str, str]:
    f = _one(table.VALUES["first name"], rng)
    if rng.random() < 0.25:
        f = _invented(rng)
    s = _invented(rng) if rng.random() < INVENTED else _one(table.VALUES["surname"], rng)
    r = rng.random()
    if r < 0.06:
        s += "-" + (_one(table.VALUES["surname"], rng) if r < 0.03 else _invented(rng))
    elif r < 0.1:
        s = ["van ", "de ", "von ", "da ", "di ", "Mc", "Le "][rng.integers(7)] + s
    if rng.random() < 0.05:
        f += "-" + _one(table.VALUES["first name"], rng)
    return f, s


def _person(rng: np.random.Generator) -> str:
    f, s = _names(rng)
    middle = "ABCDEFGHJKLMNPRSTW"[rng.integers(18)]
    name = [f"{s}, {f}", f"{s}, {f}", f"{f} {middle}. {s}", f"{f} {middle} {s}" if rng.random() < 0.3 else f"{f} {middle}. {s}", *[f"{f} {s}"] * 6][rng.integers(10)]
    r = rng.random()
    return name.upper() if r < 0.12 else name.lower() if r < 0.16 else name


def _email(rng: np.random.Generator) -> str:
    f, s = (fold(re.sub(r"[^\w-]", "", x)) for x in _names(rng))
    n = rng.integers(1, 99)
    user = [f"{f}.{s}", f"{f}.{s}", f"{f}_{s}", f"{s}.{f}", f"{f[0]}{s}", f"{f[0]}.{s}", f"{f}{n}", f"{f}.{s}{n}", f"{f}-{s}", f"{s}+{f}", f"{f}+cv", "jobs", "careers", "bewerbung", "recrutement", "hr", f"{f}{s}"][rng.integers(17)]
    domain = _one(table.VALUES["email domain"], rng)
    styles = [("@", ".")] * 12 + [(" at ", " dot "), ("(at)", "(dot)"), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" @ ", "."), ("(at)", "."), (" [at] ", "."), (" (at) ", "."), (" AT ", " DOT "), (" at ", ".")]
    at, dot = styles[rng.integers(len(styles))]
    out = user + at + domain.replace(".", dot)
    return out.upper() if rng.random() < 0.08 else out


def _address(rng: np.random.Generator) -> str:
    v = lambda name: _one(table.VALUES[name], rng)
    number = str(rng.integers(1, [10, 100, 1000, 10_000][rng.integers(4)]))
    letter = ["", "", "", "a", "b", "c", "/2", "-14"][rng.integers(8)]
    street = " ".join(_invented(rng) for _ in range(1 + rng.integers(2))) if rng.random() < 0.4 else v("street")
    stem = _invented(rng) if rng.random() < 0.4 else v("strasse")
    end = v("strasse end")
    german = v("german street") if rng.random() < 0.25 else stem + (end if end[0] != "-" else end) if rng.random() < 0.8 else f"{stem} {end.lstrip('-').capitalize()}"
    proper = lambda name: f"{['de ', 'du ', 'de la ', 'des ', ''][rng.integers(5)]}{_invented(rng)}" if rng.random() < 0.35 else v(name)
    kind = rng.integers(10)
    if kind < 4:
        out = f"{number} {street} {v('house end')}{_filled(v('unit'), rng)}"
    elif kind < 6:
        out = f"{german} {number}{letter}"
    elif kind < 8:
        french = f"{v('french way')} {proper('french name')}"
        out = [f"{number} {french}", f"{number}, {french}", f"{number} bis {french}", f"{number} ter, {french}", f"{number} bis, {french}"][rng.integers(5)]
    else:
        spanish = f"{v('spanish way')} {proper('spanish name')}"
        out = [f"{spanish} {number}", f"{spanish}, {number}", f"{spanish}, nº {number}", f"{spanish} n.º {number}", f"{spanish}, {number}, {rng.integers(1, 9)}º {'ABCD'[rng.integers(4)]}"][rng.integers(5)]
    r = rng.random()
    return out.upper() if r < 0.05 else out.lower() if r < 0.1 else out


def _value(kind: str, rng: np.random.Generator) -> str:
    made = {"person_name": _person, "email": _email, "street_address": _address}
    return made[kind](rng) if kind in made else _filled(_one(table.VALUES[kind], rng), rng)


#: Ordinary words, of which titles and terms are made.
ORDINARY = sorted({w for line in table.PLAIN for w in re.findall(r"(?<![\w{#])[a-z]{4,}(?![\w}])", line)})


def _plain(slot: str, rng: np.random.Generator) -> str:
    """What stands in a slot that holds no private value."""
    if slot in ("org", "org_low"):
        name = _one(table.VALUES["surname"], rng) if rng.random() < 0.2 else _invented(rng)
        if slot == "org_low":
            return name.lower()
        if rng.random() < 0.6:
            name += " " + _invented(rng)
        return f"{name} {_one(table.VALUES['org end'], rng)}".strip()
    if slot == "role" and rng.random() < 0.5:
        return " ".join(ORDINARY[rng.integers(len(ORDINARY))].capitalize() for _ in range(1 + int(rng.integers(3))))
    if slot in ("tool", "city") and rng.random() < 0.25:
        return _invented(rng)
    if slot == "surname" and rng.random() < INVENTED:
        return _invented(rng)
    return _one(table.VALUES[slot], rng)


def _sentence(frame: str, rng: np.random.Generator) -> tuple[str, list[tuple[int, int, int]]]:
    """A frame with its slots filled, and (start, end, kind) of the private values."""
    out, spans = "", []
    labels = list(table.IDS)
    label = labels[rng.integers(len(labels))]
    for part in re.split(r"(\{[a-z_ ]+\})", frame.replace("\\n", "\n")):
        if part[:1] != "{":
            out += _filled(part, rng)
            continue
        slot = part[1:-1]
        if slot in table.KINDS:
            value = _filled(_one(table.IDS[label], rng), rng) if slot == "id_number" else _value(slot, rng)
            if slot == "person_name" and frame[0].islower() and rng.random() < 0.4:
                value = value.lower()  # whoever writes a sentence small often writes names small
            spans.append((len(out), len(out) + len(value), table.KINDS.index(slot)))
            out += value
        else:
            out += _one(label, rng) if slot == "label" else _plain(slot, rng)
    return out, spans


def _anywhere(kind: str, rng: np.random.Generator) -> str:
    """A frame with a value of a kind, or with a thing that is none, among words of any sentence: what it shows itself must do."""
    words = [w for _ in range(2) for w in re.sub(r"\{[a-z_ ]+\}|[#^]", "", table.PLAIN[rng.integers(len(table.PLAIN))]).replace("\\n", " ").split()]
    at = int(rng.integers(1, max(2, len(words) - 1)))
    slot = table.THINGS[rng.integers(len(table.THINGS))] if kind == "" else "{label} {id_number}" if kind == "id_number" else f"{{{kind}}}"
    before, after = words[max(0, at - 4) : at], words[at : at + 4]
    if rng.random() < 0.3:
        slot = [f"({slot})", f": {slot}", f", {slot},", f"– {slot}"][rng.integers(4)]
    return f"{' '.join(before)} {slot} {' '.join(after)}".replace(" : ", ": ").replace(" , ", ", ")


def labelled_texts(count: int = TRAINING_TEXTS, seed: int = 11) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Texts of one to three sentences of the labelled table with their private values."""
    rng = np.random.default_rng(seed)
    texts = []
    # What makes a number a person's is its label alone, and labels are many: their frames come more often.
    cycle = [f for f in table.FRAMES for _ in range(5 if "{id_number}" in f else 1)]
    for n in range(count):
        text, spans = "", []
        frames = [cycle[n % len(cycle)]]
        if n % 5 == 1:
            frames = [_anywhere((*table.KINDS, "person_name", "person_name", "id_number", "", "", "")[(n // 5) % 11], rng)]
        if n % 3 == 2:
            frames = [table.PLAIN[(n // 3) % len(table.PLAIN)]]
        for side in (0, len(frames)):
            if rng.random() < 0.5:
                frames.insert(side, table.PLAIN[rng.integers(len(table.PLAIN))] if rng.random() < 0.8 else table.FRAMES[rng.integers(len(table.FRAMES))])
        for frame in frames:
            if text:
                text += [" ", "\n", "\n\n"][rng.integers(3)]
            s, found = _sentence(frame, rng)
            spans += [(a + len(text), b + len(text), k) for a, b, k in found]
            text += s
        texts.append((text, spans))
    return texts


def labelled_sequence(text: str, spans: list[tuple[int, int, int]]) -> tuple[list[str], list[int]]:
    tokens, labels, inside = [], [], -1
    for m in TOKEN.finditer(text):
        tokens.append(m[0])
        span = next((i for i, (a, b, _) in enumerate(spans) if a <= m.start() < b), -1)
        kind = 0
        if span >= 0:
            a, b, kind = spans[span]
            if table.KINDS[kind] == "person_name" and (text[a:b].islower() or text[a:b].isupper()):
                kind = 5 + text[a:b].isupper()
        labels.append(0 if span < 0 else 1 + 2 * kind + (span == inside))
        inside = span
    return tokens, labels


@lru_cache(maxsize=1)
def trained() -> Crf:
    """The field, trained once per process from the labelled table."""
    rng = np.random.default_rng(3)
    cues = {fold(t) for label in table.IDS for t in TOKEN.findall(label)}  # an id number is one by its label only
    sequences = []
    for text, spans in labelled_texts():
        tokens, labels = labelled_sequence(text, spans)
        sequences.append(([hidden(t) if rng.random() < HIDDEN and t[0] != "\n" and fold(t) not in cues else t for t in tokens], labels))
    return Crf(LABELS, letter_cases(f"{TOKENIZERS}/{CASES_VOCABULARY}")).fit(sequences)


def values(text: str, stretches: list[tuple[int, np.ndarray]]) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the values a text's labels spell."""
    spans = [m.span() for m in TOKEN.finditer(text)]
    out = []
    for first, labels in stretches:
        i = 0
        while i < len(labels):
            if not labels[i]:
                i += 1
                continue
            kind, j = (labels[i] - 1) // 2, i + 1
            while j < len(labels) and labels[j] == 2 + 2 * kind:
                j += 1
            start, end = spans[first + i][0], spans[first + j - 1][1]
            kind = KIND_OF[kind]
            out.append((start, end, kind))
            i = j
    return out


def found_values(texts: DataFrame) -> DataFrame:
    """``row_id, kind, start_pos, end_pos`` of every private value in ``row_id, text``.

    Whole texts, in one narrow stage; null and empty texts have none. The trained
    field (its size is that of the labelled table's vocabulary) is broadcast.
    """
    shared = texts.sparkSession.sparkContext.broadcast(trained())

    def tag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(shared.value)
        for batch in batches:
            ids, all_texts = batch["row_id"].to_numpy(), batch["text"].tolist()
            at = 0
            while at < len(ids):
                size, to = 0, at
                while to < len(ids) and (to == at or size < 600_000):
                    size += len(all_texts[to] or "")
                    to += 1
                rows = []
                for i, stretches in enumerate(tagger.tag(all_texts[at:to]), at):
                    if stretches:
                        rows += [(ids[i], table.KINDS[k], a, b) for a, b, k in values(all_texts[i], stretches)]
                yield pd.DataFrame(rows, columns=["row_id", "kind", "start_pos", "end_pos"]).astype({"row_id": np.int64, "start_pos": np.int64, "end_pos": np.int64})
                at = to

    return texts.select("row_id", "text").mapInPandas(tag, "row_id bigint, kind string, start_pos bigint, end_pos bigint")


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced by its kind in capitals within brackets; all else unchanged."""
    out, at = [], 0
    for a, b, kind in sorted(spans):
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def redacted(texts: DataFrame) -> DataFrame:
    """``row_id, text`` with every private value replaced by a typed placeholder; null stays null."""
    shared = texts.sparkSession.sparkContext.broadcast(trained())

    def clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(shared.value)
        for batch in batches:
            for at in range(0, len(batch), 1_000):
                part = batch.iloc[at : at + 1_000]
                all_texts = part["text"].tolist()
                new = []
                for text, stretches in zip(all_texts, tagger.tag(all_texts), strict=True):
                    new.append(redact(text, [(a, b, table.KINDS[k]) for a, b, k in values(text, stretches)]) if stretches else text)
                yield pd.DataFrame({"row_id": part["row_id"], "text": new})

    return texts.select("row_id", "text").mapInPandas(clean, "row_id bigint, text string")


def descriptions(sources: DataFrame, lever: DataFrame, ashby: DataFrame) -> DataFrame:
    """``row_id, text`` of the three description fields; rows without text are left out."""
    parts = [df.select("row_id", F.col(c).alias("text")) for df, c in ((sources, "description"), (lever, "descriptionPlain"), (ashby, "descriptionPlain"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).filter("text is not null")
