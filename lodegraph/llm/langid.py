"""Languages of documents and of their parts, words first.

A known word is scored by its log frequency in each language. A word that the model doesn't know falls
back to its longest known character n-grams, 5 characters first, 1 at last. Sentences are scored by the
sum over their words; runs of sentences in one language are the segments of a document.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodegraph.llm.tokens import row_sums

LANGUAGES = ("en", "de", "fr", "es", "it", "pt", "nl", "ja")
#: What a right label of each language may be, in any letter case, with or without region.
LABELS = {
    "en": ("en", "eng", "english"),
    "de": ("de", "deu", "ger", "german"),
    "fr": ("fr", "fra", "fre", "french"),
    "es": ("es", "spa", "spanish"),
    "it": ("it", "ita", "italian"),
    "pt": ("pt", "por", "portuguese"),
    "nl": ("nl", "nld", "dut", "dutch"),
    "ja": ("ja", "jpn", "japanese"),
}
#: Bounds of what the model is fitted on: labelled documents and distinct words of each language.
SAMPLE_DOCUMENTS, SAMPLE_WORDS = 400, 20_000
LONGEST_GRAM = 5
#: Score differences of one word are limited to this many nats, as labels of the sample may be wrong.
WORD_RANGE = 6.0
#: The same for a word known only by its n-grams.
GRAM_RANGE = 3.0
#: Times a word stands in the sample at least to be known as a word.
LEAST_COUNT = 3
#: Words a sentence of natural language has at least, and Japanese characters.
LEAST_WORDS, LEAST_KANA = 3, 4
#: A sentence whose best language is ahead by less than this many nats follows its neighbours.
LEAST_MARGIN = 3.0

#: Words: runs of letters; Japanese ones also end where the script changes.
_WORD = re.compile(r"[\u3041-\u309f]+|[\u30a0-\u30ff]+|[\u3400-\u9fff\u3005]+|[^\W\d_\u3005\u3041-\u30ff\u3400-\u9fff]+")
#: The same within text without Japanese characters, and all that is no letter within plain ASCII.
_LETTERS = re.compile(r"[^\W\d_]+")
_GAPS = "".join(chr(i) if chr(i).isalpha() else " " for i in range(128))
_EAST = re.compile(r"[\u3005\u3041-\u30ff\u3400-\u9fff]")
#: Ends of sentences.
_SENTENCE = re.compile(r"[。！？]|[.!?][)\"'»”]?(?=\s)")
_LINE = re.compile(r"\r\n|\n|\r|\u2028|\u2029|\x85")
_BRACKETED = re.compile(r"\[[^\]\n]*\]|\([A-Z][A-Z0-9]*-[A-Z0-9-]+\)")
_HEADING = re.compile(r"\s*(#{1,6}\s|=+\s|\*{3,})")
#: Identifiers: a hyphen, underscore, dot or digit within a run of capitals.
_NAME = re.compile(r"[A-Z](?<!\w[A-Z])(?=[A-Z0-9.$#@_-]*[0-9._-])[A-Z0-9$#@_-]*(?:[.][A-Z0-9$#@_-]+)*\b")
#: Words that open COBOL, SQL and JCL statements.
_VERBS = "MOVE|PERFORM|ADD|SUBTRACT|MULTIPLY|DIVIDE|COMPUTE|IF|ELSE|END-IF|EVALUATE|WHEN|END-EVALUATE|CALL|EXEC|END-EXEC|DISPLAY|STRING|UNSTRING|INITIALIZE|INSPECT|GO TO|GOBACK|STOP RUN|EXIT|CONTINUE|OPEN|CLOSE|READ|WRITE|REWRITE|DELETE|START|ACCEPT|SET|COPY|SELECT|INSERT|UPDATE|FROM|WHERE|VALUES"
#: The code that a line opens with: a statement in capitals that names something, a JCL statement, a data
#: entry, a paragraph's name, a free-form comment mark. What stands behind it may still be text.
_CODE = re.compile(
    rf"(?:\d{{6}}|      )?[ *]?\s*(?:(?:{_VERBS})\b(?=[^a-z]*(?:[A-Z]-[A-Z]|'|\d|=))[^a-z]*|(?:{_VERBS})\s*\.?\s*$|//.*|\d\d\s+[A-Z][A-Z0-9-]*\s+(?:PIC|VALUE|REDEFINES|OCCURS)\b.*|[A-Z0-9]+(?:-[A-Z0-9]+)+\.\s*$|\*>)"
)
_KANA = re.compile(r"[぀-ヿ㐀-䶿一-鿿々ー]")
_UMLAUTS = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss", "æ": "ae", "œ": "oe"})


def label_language(c: str | Column) -> Column:
    """Language that a label names, null for a label that names none of the known ones."""
    c = F.col(c) if isinstance(c, str) else c
    base = F.regexp_replace(F.lower(F.trim(c)), r"[-_][a-z0-9]{2,4}$", "")
    names = F.create_map(*[F.lit(x) for lang, ls in LABELS.items() for label in ls for x in (label, lang)])
    return F.try_element_at(names, base)


def fold(word: str) -> str:
    """Lower case without accents; umlauts as they are spelled where accents are lost."""
    word = unicodedata.normalize("NFC", word.lower()).translate(_UMLAUTS)
    return "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))


def sentences(text: str) -> list[str]:
    """Sentences of a text; headings, bracketed names and code are left out."""
    out = []
    for line in _LINE.split(text):
        if not line or line.isspace() or _HEADING.match(line):
            continue
        if code := _CODE.match(line):
            line = line[code.end() :]
        if "[" in line or "(" in line:
            line = _BRACKETED.sub(" ", line)
        at = 0
        for end in _SENTENCE.finditer(line):
            out.append(line[at : end.end()])
            at = end.end()
        out.append(line[at:])
    return [s for s in out if s and not s.isspace()]


def natural_words(sentence: str) -> list[str] | None:
    """Words of a sentence of natural language without the names in it; None if it is too little."""
    said = _NAME.sub(" ", sentence)
    words = said.translate(_GAPS).split() if said.isascii() else (_WORD if _EAST.search(said) else _LETTERS).findall(said)
    if len(words) >= LEAST_WORDS and len([w for w in words if len(w) > 1]) >= LEAST_WORDS:
        return words
    return words if not sentence.isascii() and len(_KANA.findall(sentence)) >= LEAST_KANA else None


class Model:
    """Log frequencies of words and of character n-grams per language."""

    def __init__(self, counts: Iterable[tuple[str, str, int]], languages: tuple[str, ...] = LANGUAGES):
        self.languages = languages
        at = {lang: i for i, lang in enumerate(languages)}
        words: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(languages)))
        grams: list[dict[str, np.ndarray]] = [defaultdict(lambda: np.zeros(len(languages))) for _ in range(LONGEST_GRAM + 1)]
        for lang, word, n in counts:
            if lang in at:
                words[word][at[lang]] += n
        for word, c in words.items():
            for g, size in self._grams(word):
                grams[size][g] += c
        # A label may be wrong, so a word that is rare in the sample is known by its n-grams only.
        self.words = self._logs({w: c for w, c in words.items() if c.sum() >= LEAST_COUNT})
        self.grams = [self._logs(g) for g in grams]

    @staticmethod
    def _grams(word: str) -> Iterator[tuple[str, int]]:
        marked = f" {word} "
        for size in range(1, LONGEST_GRAM + 1):
            for i in range(len(marked) - size + 1):
                g = marked[i : i + size]
                if g != " ":
                    yield g, size

    @staticmethod
    def _logs(table: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        if not table:
            return {}
        total = sum(table.values()) + 1.0
        out = {}
        for k, c in table.items():
            v = np.log((c + 0.02 * total / total.max()) / total + 1e-9)
            out[k] = np.maximum(v - v.max(), -WORD_RANGE).astype(np.float32)
        return out

    def score(self, word: str) -> np.ndarray:
        """Nats of each language behind the best, for a folded word."""
        known = self.words.get(word)
        if known is not None:
            return known
        marked = f" {word} "
        for size in range(LONGEST_GRAM, 0, -1):
            found = [v for i in range(len(marked) - size + 1) if (v := self.grams[size].get(marked[i : i + size])) is not None]
            if found:
                v = sum(found) / math.sqrt(len(found))
                return np.maximum(v - v.max(), -GRAM_RANGE)
        return np.zeros(len(self.languages), dtype=np.float32)


def _sample_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n: dict[tuple[str, str], int] = defaultdict(int)
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for s in sentences(text):
                for w in natural_words(s) or ():
                    n[lang, fold(w)] += 1
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in n], pa.string()), pa.array([k[1] for k in n], pa.string()), pa.array(list(n.values()), pa.int64())], names=["lang", "word", "n"])


def labelled_words(df: DataFrame, key: str, text: str, label: str, documents: int = SAMPLE_DOCUMENTS, words: int = SAMPLE_WORDS) -> list[tuple[str, str, int]]:
    """(language, word, count) of a bounded sample of labelled documents.

    The sample holds `documents` texts of each label, those of the least key hashes, and the `words` most
    frequent words of each: this bounds what reaches the driver, whatever the corpus holds."""
    labelled = df.select(F.col(key).alias("k"), label_language(label).alias("lang")).filter("lang is not null")
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("k"), "k")
    chosen = labelled.withColumn("r", F.row_number().over(by_hash)).filter(F.col("r") <= documents).select("k", "lang")
    texts = df.select(F.col(key).alias("k"), F.col(text).alias("text")).filter("text is not null").join(F.broadcast(chosen), "k")
    counts = texts.select("lang", "text").mapInArrow(_sample_words, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    return [(r.lang, r.word, r.n) for r in counts.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= words).collect()]


class Identifier:
    """Scores batches of texts; word scores are remembered per worker."""

    def __init__(self, model: Model):
        self.model, self.ids, self.vectors = model, {}, []

    def word_ids(self, words: list[str]) -> list[int]:
        ids = self.ids
        out = list(map(ids.get, words))
        if None in out:
            for k, i in enumerate(out):
                if i is None:
                    w = words[k]
                    i = ids.get(w)
                    if i is None:
                        i = ids[w] = len(self.vectors)
                        self.vectors.append(self.model.score(fold(w)))
                    out[k] = i
        return out

    def segments(self, texts: list[str | None]) -> list[list[tuple[int, float, int, int]]]:
        """Per text, its segments: (language index, confidence, sentences, words)."""
        if not self.model.grams[1]:
            return [[] for _ in texts]
        if len(self.vectors) > 400_000:
            self.ids, self.vectors = {}, []
        flat: list[int] = []
        bounds, owners = [0], []
        for i, text in enumerate(texts):
            for s in sentences(text or ""):
                words = natural_words(s)
                if words:
                    flat += self.word_ids(words)
                    bounds.append(len(flat))
                    owners.append(i)
        out: list[list[tuple[int, float, int, int]]] = [[] for _ in texts]
        if not owners:
            return out
        table = np.array(self.vectors, dtype=np.float64)
        offsets = np.array(bounds)
        sums = row_sums(table[np.array(flat)], offsets)
        n = np.diff(offsets)
        best = sums.argmax(axis=1)
        ranked = np.sort(sums, axis=1)
        margin = ranked[:, -1] - ranked[:, -2]
        start = 0
        owners_a = np.array(owners)
        stops = np.append(np.flatnonzero(np.diff(owners_a)) + 1, len(owners_a))
        for stop in stops.tolist():
            runs: list[list] = []
            lang = best[start:stop].copy()
            sure = margin[start:stop] >= LEAST_MARGIN
            if sure.any():
                # Unsure sentences take the language of the sure one before, or of the first sure one.
                at = np.maximum.accumulate(np.where(sure, np.arange(len(lang)), -1))
                lang = lang[np.where(at < 0, sure.argmax(), at)]
            else:
                lang[:] = sums[start:stop].sum(axis=0).argmax()
            for j in range(stop - start):
                if runs and runs[-1][0] == lang[j]:
                    runs[-1][1] += sums[start + j]
                    runs[-1][2] += 1
                    runs[-1][3] += int(n[start + j])
                else:
                    runs.append([int(lang[j]), sums[start + j].copy(), 1, int(n[start + j])])
            for lang_no, total, k, words in runs:
                # Confidence: the share of the segment's language, tempered by its number of words.
                p = np.exp((total - total.max()) / math.sqrt(max(words, 1)))
                out[owners[start]].append((lang_no, float(p[lang_no] / p.sum()), k, words))
            start = stop
        return out


_IDENTIFIERS: dict[str, Identifier] = {}


_SEGMENT = "struct<seg_no:int,lang:string,confidence:double,sentences:int,words:int>"


def identified(df: DataFrame, key: str, text: str, label: str, model: Model) -> DataFrame:
    """(key, label_lang, lang, confidence, n_langs, segments) of every row of `df`, from one pass over Arrow batches.

    lang is that of most words (the last in the alphabet of equals), confidence the mean of its segments'
    by words. Null and blank texts, and those without a sentence of natural language, have no segments and
    no lang; nor has any text under a model that was fitted on nothing."""
    packed = pickle.dumps(model)
    shared, name = df.sparkSession.sparkContext.broadcast(packed), hashlib.sha1(packed).hexdigest()
    languages = model.languages
    segment = pa.struct([("seg_no", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64()), ("sentences", pa.int32()), ("words", pa.int32())])

    def identify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _IDENTIFIERS:
            _IDENTIFIERS.clear()
            _IDENTIFIERS[name] = Identifier(pickle.loads(shared.value))
        for batch in batches:
            found = _IDENTIFIERS[name].segments([t or "" for t in batch.column("t").to_pylist()])
            langs, sure, n_langs = [], [], []
            for segs in found:
                by: dict[str, list[float]] = {}
                for lang, confidence, _, words in segs:
                    at = by.setdefault(languages[lang], [0.0, 0.0])
                    at[0] += words
                    at[1] += words * confidence
                lang = max(by, key=lambda x: (by[x][0], x), default=None)
                langs.append(lang)
                sure.append(None if lang is None else by[lang][1] / by[lang][0] if by[lang][0] else 0.0)
                n_langs.append(len(by))
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            rows = [(no, languages[s[0]], *s[1:]) for segs in found for no, s in enumerate(segs, 1)]
            cols = list(zip(*rows)) if rows else [()] * 5
            flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, segment)], fields=list(segment))
            out = [batch.column("k"), batch.column("label_lang"), pa.array(langs, pa.string()), pa.array(sure, pa.float64()), pa.array(n_langs, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)]
            yield pa.RecordBatch.from_arrays(out, names=["k", "label_lang", "lang", "confidence", "n_langs", "segments"])

    kt = df.schema[key].dataType.simpleString()
    texts = df.select(F.col(key).alias("k"), label_language(label).alias("label_lang"), F.col(text).alias("t"))
    return texts.mapInArrow(identify, f"k {kt}, label_lang string, lang string, confidence double, n_langs int, segments array<{_SEGMENT}>").withColumnRenamed("k", key)


def with_segments(df: DataFrame, key: str, text: str, label: str, model: Model) -> DataFrame:
    """(key, label_lang, seg_no, lang, confidence, sentences, words) of every segment of every text."""
    return identified(df.filter(F.col(text).isNotNull()), key, text, label, model).select(key, "label_lang", F.inline("segments"))


def fitted(df: DataFrame, key: str, text: str, label: str) -> Model:
    return Model(labelled_words(df, key, text, label))


def documents(df: DataFrame, key: str, text: str, label: str, model: Model) -> DataFrame:
    """(key, lang, confidence, n_segments, label_status, segments) of every row of `df`.

    lang is that of most words; null without natural language. label_status: right, missing (null, blank
    or no language), wrong, mixed (several languages), none (no natural language)."""
    status = F.when(F.col("lang").isNull(), "none").when(F.col("n_langs") > 1, "mixed").when(F.col("label_lang").isNull(), "missing").when(F.col("label_lang") == F.col("lang"), "right").otherwise("wrong")
    segments = F.transform("segments", lambda s: F.struct(s["seg_no"].alias("seg_no"), s["lang"].alias("lang"), F.round(s["confidence"], 4).alias("confidence"), s["words"].alias("words")))
    return identified(df, key, text, label, model).select(key, "lang", F.round("confidence", 4).alias("confidence"), F.size("segments").alias("n_segments"), status.alias("label_status"), segments.alias("segments"))


def mislabelled(df: DataFrame, key: str, text: str, label: str, model: Model) -> DataFrame:
    """(key, seg_no, lang) of the documents whose label is missing or wrong, or that hold several languages."""
    found = identified(df.filter(F.col(text).isNotNull()), key, text, label, model)
    wrong = (F.size("segments") > 1) | F.col("label_lang").isNull() | (F.col("label_lang") != F.col("lang"))
    return found.filter(wrong).select(key, F.inline("segments")).select(key, "seg_no", "lang")
