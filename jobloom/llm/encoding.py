"""Token ids of whole texts by a public byte-level vocabulary.

The merges run as recursive DuckDB queries inside each Spark task: a table of
token-position rows joins the merge table, and each round contracts, word by
word, the pair of least rank (leftmost first where occurrences overlap), until
no word changes. Each different word is encoded once per task; the ids of a text
are those of its words in order.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.json"

# Fixed value: the published word pattern of this byte-level vocabulary.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words encoded by one recursive query.
WORDS_A_QUERY = 16_000
#: Bytes of a word that is still contracted by the recursive query; it keeps all rounds, whose number grows with the length.
BYTES_A_WORD = 400
#: Different words a task remembers; the memory is emptied when full.
WORDS_KEPT = 150_000
#: Characters of text taken up before the words met so far are encoded.
CHARS_A_ROUND = 2_000_000

#: One round: neighbours joined to the merge table, the least rank of each word
#: contracted. Equal neighbours (``aa``) overlap, so of those only the leftmost goes.
RECURSION = """
WITH RECURSIVE rounds(it, w, pos, tok) AS (
  SELECT 0, w, pos, tok FROM symbols
  UNION ALL
  SELECT it + 1, w, pos, CASE WHEN hit THEN merged ELSE tok END
  FROM (
    SELECT *, coalesce(lag(hit) OVER (PARTITION BY w ORDER BY pos), false) AS eaten
    FROM (
      SELECT *, rank IS NOT NULL AND rank = least AND (tok <> nxt OR pos = leftmost) AS hit
      FROM (
        SELECT *, min(CASE WHEN rank = least THEN pos END) OVER (PARTITION BY w) AS leftmost
        FROM (
          SELECT n.*, m.rank, m.merged, min(m.rank) OVER (PARTITION BY n.w) AS least
          FROM (SELECT it, w, pos, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS nxt FROM rounds) n
          LEFT JOIN merges m ON m.l = n.tok AND m.r = n.nxt
        )
        WHERE least IS NOT NULL
      )
    )
  )
  WHERE NOT eaten
)
SELECT w, list(tok ORDER BY pos) AS ids
FROM (SELECT *, max(it) OVER (PARTITION BY w) AS last FROM rounds)
WHERE it = last
GROUP BY w
"""


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies (public rule)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def merge_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """(id of each byte, rows ``left id, right id, rank, merged id``) of a byte-level vocabulary file."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model["vocab"]
    bytes_to_ids = np.zeros(256, dtype=np.int32)
    for character, byte in byte_symbols().items():
        bytes_to_ids[byte] = vocab[character]
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    merges = np.array([(vocab[a], vocab[b], rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)], dtype=np.int32)
    return bytes_to_ids, merges


class WordEncoder:
    """Encodes words by recursive queries over the merge table, in this process."""

    def __init__(self, bytes_to_ids: np.ndarray, merges: np.ndarray) -> None:
        import duckdb

        self.bytes_to_ids = bytes_to_ids
        self.rank = {(int(a), int(b)): (int(r), int(m)) for a, b, r, m in merges.tolist()}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        columns = {name: merges[:, i] for i, name in enumerate(("l", "r", "rank", "merged"))}
        self.db.register("m", pd.DataFrame(columns))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM m")
        self.known: dict[str, list[int]] = {}

    def _query(self, words: list[str]) -> None:
        encoded = [w.encode("utf-8") for w in words]
        lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        symbols = pd.DataFrame(
            {
                "w": np.repeat(np.arange(len(words), dtype=np.int32), lengths),
                "pos": (np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32),
                "tok": self.bytes_to_ids[np.frombuffer(b"".join(encoded), dtype=np.uint8)],
            }
        )
        self.db.register("symbols", symbols)
        out = self.db.execute(RECURSION).fetchnumpy()
        for w, ids in zip(out["w"].tolist(), out["ids"], strict=True):
            self.known[words[w]] = ids.tolist()
        self.db.unregister("symbols")

    def _long(self, word: str) -> list[int]:
        """The ids of a long word: the same contractions, the next one taken from a queue instead of by a round over the whole word."""
        ids = self.bytes_to_ids[np.frombuffer(word.encode("utf-8"), dtype=np.uint8)].tolist()
        before, after = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
        queue = [(*self.rank[p], i, *p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.rank]
        queue = [(rank, i, merged, l, r) for rank, merged, i, l, r in queue]
        heapify(queue)
        while queue:
            _, i, merged, l, r = heappop(queue)
            j = after[i]
            if ids[i] != l or j >= len(ids) or ids[j] != r:
                continue  # one of the two has gone into another token
            ids[i], ids[j], after[i] = merged, -1, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < len(ids):
                    pair = (ids[a], ids[after[a]])
                    if pair in self.rank:
                        rank, new = self.rank[pair]
                        heappush(queue, (rank, a, new, *pair))
        return [t for t in ids if t >= 0]

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words not yet known, those of like length in one query."""
        new = sorted({w for w in words if w not in self.known}, key=len)
        while new and len(new[-1]) * 4 > BYTES_A_WORD and len(new[-1].encode("utf-8")) > BYTES_A_WORD:
            word = new.pop()
            self.known[word] = self._long(word)
        part: list[str] = []
        size = 0
        for w in new:
            if part and (len(part) == WORDS_A_QUERY or size + len(w) ** 2 > 160 * WORDS_A_QUERY):
                self._query(part)
                part, size = [], 0
            part.append(w)
            size += len(w) ** 2
        if part:
            self._query(part)


def encode_texts(df: DataFrame, key: str, text: str, vocabulary: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """``key, ids array<int>``: the token ids of each row's text, without special tokens.

    Empty and null texts have an empty list. Strings that spell a special token
    are ordinary text. One narrow stage: the merge table (its size is that of the
    vocabulary, about a megabyte) is broadcast, the corpus isn't shuffled, and
    repeated rows are encoded alike.
    """
    import regex

    shared = df.sparkSession.sparkContext.broadcast(merge_table(vocabulary))
    key_type = df.schema[key].dataType.simpleString()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pattern = regex.compile(WORD_PATTERN)
        encoder = WordEncoder(*shared.value)
        for batch in batches:
            keys, texts = batch["k"].tolist(), batch["t"].tolist()
            at = 0
            while at < len(keys):
                start, chars, split = at, 0, []
                while at < len(keys) and (at == start or chars < CHARS_A_ROUND):
                    words = pattern.findall(texts[at] or "")
                    chars += len(texts[at] or "")
                    split.append(words)
                    at += 1
                if len(encoder.known) > WORDS_KEPT:
                    encoder.known.clear()
                encoder.learn({w for words in split for w in words})
                known = encoder.known
                ids = [np.fromiter((i for w in words for i in known[w]), dtype=np.int32) for words in split]
                yield pd.DataFrame({"k": keys[start:at], "ids": ids})

    picked = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return picked.mapInPandas(encode, f"k {key_type}, ids array<int>").withColumnRenamed("k", key)


#: Decoding: each id joined to its bytes, put together in order.
DECODING = """
SELECT k, string_agg(bytes, '' ORDER BY pos) AS hex
FROM (SELECT k, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM coded) JOIN tokens USING (id)
GROUP BY k
"""


@lru_cache(maxsize=2)
def token_bytes(path: str) -> pd.DataFrame:
    """``id, bytes`` (hexadecimal) of every token of a byte-level vocabulary file."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    symbols = byte_symbols()
    known = {t: i for t, i in vocab.items() if all(c in symbols for c in t)}
    return pd.DataFrame({"id": list(known.values()), "bytes": [bytes(symbols[c] for c in t).hex() for t in known]})


def decode_ids(df: DataFrame, key: str, ids: str, vocabulary: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """``key, text``: the text each row's token ids stand for; an empty or null list is the empty text.

    An ordered aggregation in DuckDB within each task; bytes that are no text are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(token_bytes(vocabulary))
    key_type = df.schema[key].dataType.simpleString()

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import duckdb

        db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        db.register("t", shared.value)
        db.execute("CREATE TABLE tokens AS SELECT * FROM t")
        for batch in batches:
            for at in range(0, len(batch), 2_000):
                part = batch.iloc[at : at + 2_000]
                coded = pd.DataFrame({"k": range(len(part)), "ids": part["ids"].tolist()})  # noqa: F841
                found = {k: bytes.fromhex(h).decode("utf-8", "replace") for k, h in db.execute(DECODING).fetchall()}
                yield pd.DataFrame({"k": part["k"].tolist(), "text": [found.get(i, "") for i in range(len(part))]})

    picked = df.select(F.col(key).alias("k"), F.coalesce(ids, F.array().cast("array<int>")).alias("ids"))
    return picked.mapInPandas(decode, f"k {key_type}, text string").withColumnRenamed("k", key)
