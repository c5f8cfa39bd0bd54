"""Garbled text from wrong character encodings (problem 9).

Method: a multinomial classifier on hashed byte bigrams is trained on synthetically garbled words of
the documents themselves and predicts the exact chain of encodings. The chain is inverted, and what
comes out must decode strictly; it must also be likelier as clean text than what stood there.

The unit is a word that holds a character beyond ASCII (or a question mark between letters, which is
what is left of characters an encoding did not have). The evidence of the words of a sentence is
added up, each word once; a document is found if a sentence's evidence for one chain passes a threshold.
How often the corpus has a word, and what it would be restored to, bounds what it says.

Training: all distinct texts are read for words; copies add nothing. Words that a chain turns into a
likelier word of the corpus are left out of the clean class. Every word of every document is then
judged by the classifier, over whole texts.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedarloom.io import cut

BUCKETS = 1 << 14
SMOOTH = 0.05
THRESHOLD = 6.0
PIECE = 200
# whole words are hashed too; what one word can say against its being clean, where the corpus has it
WORDS, WHOLE = 1 << 20, 6.0
# a clean word with an odd sign is garbled somewhere in a large corpus, and that may look like what it
# would be restored to: what is so many times rarer makes no word suspect
RARER = 10
# Letters and signs of the corpus languages (en, fr, es, pt, de, pl).
ALPHABET = frozenset("éèêëàâäçîïôöûüùÿœæñáíóúßãõąćęłńśźżÉÈÊËÀÂÄÇÎÏÔÖÛÜÙŒÆÑÁÍÓÚÃÕĄĆĘŁŃŚŹŻ¿¡«»„“”’‘–—…°§€£ºª ")
# Chains of (encoding it was in, encoding it was read in), first to last.
_READ_AS = ["cp1252", "latin-1", "iso8859-2", "mac_roman", "cp437", "cp850", "cp852", "cp1250", "cp1251", "cp1254"]
CHAINS: list[tuple[tuple[str, str], ...]] = [
    *((("utf-8", e),) for e in _READ_AS),
    (("utf-8", "cp1252"),) * 2,
    (("utf-8", "latin-1"),) * 2,
    (("utf-8", "latin-1"), ("utf-8", "cp1252")),
    (("utf-8", "cp1252"), ("utf-8", "latin-1")),
    (("utf-8", "cp1250"),) * 2,
    (("utf-8", "mac_roman"),) * 2,
    *(((a, b),) for a, b in (
        ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1252", "mac_roman"), ("cp1252", "cp1251"), ("cp1252", "cp1250"), ("cp1252", "latin-1"),
        ("cp1250", "cp1252"), ("cp1250", "cp437"), ("cp1250", "cp852"), ("cp1250", "mac_roman"), ("cp1250", "cp1251"), ("iso8859-2", "cp1252"),
        ("mac_roman", "cp1252"), ("cp850", "cp1252"), ("cp852", "cp1250"),
    )),
]
LOSSY = ["cp1252", "latin-1", "ascii"]
CLASSES = ["clean", *("+".join(f"{a}>{b}" for a, b in c) for c in CHAINS), *(f"{e}>lost" for e in LOSSY)]
WORD = re.compile(r"[^ \n\t\r]*[^\x00-\x7f][^ \n\t\r]*|[^ \n\t\r]*\w\?\w[^ \n\t\r]*")
LOST = re.compile(r"\w\?\w")
GAP = re.compile(r"[ \n\t\r]+")
SENTENCE = re.compile(r"(?<=[.!?]) +|[\n\r]+")


@lru_cache
def _tables(enc: str) -> tuple[list[str], dict[str, int]]:
    """Byte to character, and back; a byte the encoding leaves open is the control of that number."""
    chars = []
    for i in range(256):
        try:
            chars.append(bytes([i]).decode(enc))
        except UnicodeDecodeError:
            chars.append(chr(i))
    return chars, {c: i for i, c in enumerate(chars)}


def _encode(text: str, enc: str) -> bytes | None:
    if enc == "utf-8":
        try:
            return text.encode()
        except UnicodeEncodeError:
            return None
    back = _tables(enc)[1]
    try:
        return bytes([back[c] for c in text])
    except KeyError:
        return None


def _decode(raw: bytes, enc: str) -> str | None:
    if enc == "utf-8":
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return None
    chars = _tables(enc)[0]
    return "".join([chars[b] for b in raw])


def garble(text: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    for was, read in chain:
        raw = _encode(text, was)
        if raw is None:
            return None
        text = _decode(raw, read)
    return text


def invert(text: str, chain: tuple[tuple[str, str], ...]) -> str | None:
    """The original of a garbled text; null if it does not decode strictly."""
    for was, read in reversed(chain):
        raw = _encode(text, read)
        text = None if raw is None else _decode(raw, was)
        if text is None:
            return None
    return text


def lose(text: str, enc: str) -> str:
    """What is left of a text written in `enc` with replacements and read as UTF-8."""
    return text.encode(enc, "replace").decode("utf-8", "replace")


def bigrams(word: str) -> list[int]:
    raw = b" " + word.encode("utf-8", "surrogatepass") + b" "
    # only pairs that touch a byte beyond ASCII or a question mark speak of encodings
    return [zlib.crc32(raw[i : i + 2]) % BUCKETS for i in range(len(raw) - 1) if raw[i] > 127 or raw[i + 1] > 127 or raw[i] == 63 or raw[i + 1] == 63]


def words_of(text: str) -> list[str]:
    """What WORD finds, in time linear in the length of the words."""
    if text.isascii() and "?" not in text:
        return []
    return [w for w in GAP.split(text) if not w.isascii() or "?" in w and LOST.search(w)]


def _known(text: str) -> bool:
    return all(c in ALPHABET for c in text if ord(c) > 127)


def _undone(word: str) -> list[tuple[str, bool]] | None:
    """What the chains make of a word of the corpus, and whether it is enough that the corpus has
    that and not much more rarely, as the word has characters beyond the alphabets and what comes out has none; else
    it must be more frequent. A mere symbol is undone by chains through UTF-8 only. None: the word
    is suspect whatever the corpus has, since it has lost characters, or a chain through UTF-8
    restores it to the alphabets."""
    if "\ufffd" in word or LOST.search(word):
        return None
    out, odd = {}, not _known(word)
    for chain in CHAINS:
        back = invert(word, chain)
        if back is not None and back != word:
            strict = chain[0][0] == "utf-8"
            if strict and not back.isascii() and _known(back):
                return None
            if strict or re.search("[A-Za-z]", word):
                out[back] = odd and _known(back)
    return list(out.items())


def bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORDS


def train(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities, a row a class, and the counts of clean words by bucket. docs: (doc_id,
    text). The words of all distinct texts are counted, judged and garbled on the executors, very long
    ones in pieces; what comes to the driver is one count for each class and bucket. Equal texts are
    told by their digests, so that only words are shuffled, not texts."""

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t in b["text"]:
                if isinstance(t, str) and (found := words_of(t)):
                    seen = Counter(w[i : i + PIECE] for w in found for i in range(0, len(w), PIECE))
                    rows.append((hashlib.md5(t.encode("utf-8", "surrogatepass")).digest(), list(seen), list(seen.values())))
            if rows:
                yield pd.DataFrame(rows, columns=["digest", "words", "ns"])

    texts = docs.select("text").mapInPandas(words, "digest binary, words array<string>, ns array<bigint>").dropDuplicates(["digest"])
    every = cut(texts.selectExpr("inline(arrays_zip(words, ns)) as (word, n)").groupBy("word").agg(F.sum("n").alias("n")), "words")

    def undo(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for word, n in zip(b["word"], b["n"], strict=True):
                back = _undone(word)
                rows += [(word, n, word, False)] if back is None else [(word, n, x, any_) for x, any_ in back]
            yield pd.DataFrame(rows, columns=["own", "own_n", "word", "enough"])

    undone = every.repartition(24).mapInPandas(undo, "own string, own_n bigint, word string, enough boolean")
    suspect = undone.join(every, "word").where(f"own = word or enough and n * {RARER} >= own_n or n > own_n").selectExpr("own as word").distinct()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((len(CLASSES), BUCKETS), dtype="int64")
        for b in batches:
            for word, n in zip(b["word"], b["n"], strict=True):
                forms = [word, *(garble(word, c) for c in CHAINS), *(lose(word, e) for e in LOSSY)]
                for k, form in enumerate(forms):
                    if form is not None and (k == 0 or form != word):
                        np.add.at(sums[k], bigrams(form), n)
            yield pd.DataFrame({"k": -1, "j": [bucket(w) for w in b["word"]], "n": b["n"].to_numpy()})
        k, j = sums.nonzero()
        if len(k):
            yield pd.DataFrame({"k": k.astype("int32"), "j": j.astype("int32"), "n": sums[k, j]})

    clean = every.join(suspect, "word", "left_anti").repartition(24)
    rows = clean.mapInPandas(count, "k int, j int, n bigint").groupBy("k", "j").agg(F.sum("n").alias("n")).toPandas()
    whole, rows = rows[rows["k"] < 0], rows[rows["k"] >= 0]
    seen = np.zeros(WORDS, dtype="int64")
    seen[whole["j"].to_numpy()] = whole["n"].to_numpy()
    sums = np.full((len(CLASSES), BUCKETS), SMOOTH)
    sums[rows["k"].to_numpy(), rows["j"].to_numpy()] += rows["n"].to_numpy()
    return np.log(sums / sums.sum(axis=1, keepdims=True)).astype("float32"), seen.astype("int32")


class Judge:
    """Evidence of words and sentences under a trained model."""

    def __init__(self, model: np.ndarray, seen: np.ndarray, threshold: float = THRESHOLD):
        self.model, self.seen, self.threshold, self.known = model, seen, threshold, {}

    def word(self, word: str) -> tuple[tuple[int, float, str | None], ...]:
        """(class, evidence, restored) for each chain that speaks for the word being garbled."""
        if word in self.known:
            return self.known[word]
        at = bigrams(word)
        score = self.model[:, at].sum(axis=1)
        out, n, letters = [], int(self.seen[bucket(word)]), re.search("[A-Za-z]", word)
        for k in range(1, len(CLASSES)):
            gain = float(score[k] - score[0])
            if gain <= 0:
                continue
            if k <= len(CHAINS):
                if not letters and CHAINS[k - 1][0][0] != "utf-8":
                    continue  # a mere symbol or number speaks for chains through UTF-8 only
                back = invert(word, CHAINS[k - 1])
                if back is None or back == word:
                    continue
                plain = bigrams(back)
                # as clean text, what comes out must be likelier than what stands there
                gain = min(gain, float(self.model[0, plain].sum() - score[0]))
                if n:  # nor may the word as a whole be much commoner than what comes out
                    gain = min(gain, WHOLE + math.log((int(self.seen[bucket(back)]) + 0.5) / (n + 0.5)))
                if gain > 0:
                    out.append((k, gain, back))
            elif "\ufffd" in word or LOST.search(word):
                out.append((k, gain, None))
        if len(self.known) > 500_000:
            self.known.clear()
        self.known[word] = tuple(out)
        return self.known[word]

    def sentences(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(start, end, class) of the sentences that are garbled."""
        if not any(self.word(w) for w in words_of(text)):
            return
        at = 0
        for gap in [*SENTENCE.finditer(text), None]:
            end = gap.start() if gap else len(text)
            sums: dict[int, float] = {}
            for w in set(words_of(text[at:end])):
                for k, gain, _ in self.word(w):
                    sums[k] = sums.get(k, 0) + gain
            if sums and max(sums.values()) >= self.threshold:
                yield at, end, max(sums, key=sums.get)
            at = gap.end() if gap else end

    def restore(self, text: str) -> tuple[str, list[str], bool]:
        """(text with what can be restored, the chains found, whether all of it could be)."""
        chains, whole, parts, done = [], True, [], 0
        for start, end, k in self.sentences(text):
            chains.append(CLASSES[k])
            if k > len(CHAINS):
                whole = False
                continue
            fix = lambda m, k=k: next((b for c, _, b in self.word(m[0]) if c == k), m[0])
            parts += [text[done:start], WORD.sub(fix, text[start:end])]
            done = end
        return "".join([*parts, text[done:]]), sorted(set(chains)), whole


def judged(docs: DataFrame, threshold: float = THRESHOLD, texts: bool = False) -> DataFrame:
    """(doc_id, chains, restorable[, restored]) of the documents (doc_id, text) that hold a garbled
    stretch. Null and empty texts hold none; an empty table gives an empty one. Equal texts are
    judged alike. The model (a row a chain, BUCKETS columns) is of fixed size and broadcast."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(docs))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Judge(*model.value, threshold)
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                if not isinstance(text, str) or text.isascii() and "?" not in text:
                    continue
                restored, chains, whole = own.restore(text)
                if chains:
                    rows.append((doc_id, ",".join(chains), whole, *([restored] if texts else [])))
            if rows:
                yield pd.DataFrame(rows, columns=["doc_id", "chains", "restorable", *(["restored"] if texts else [])])

    return docs.select("doc_id", "text").mapInPandas(judge, "doc_id bigint, chains string, restorable boolean" + ", restored string" * texts)
