"""Language ID of texts that may mix languages.

Script ranges narrow the candidates of each word to the languages that use its script.  Among these, the word's
score is a naive Bayes score of its hashed character n-grams.  A Viterbi pass over the words of a text, with a
penalty for every switch, labels spans; the language with most letters names the text.

The model is learned from at most about ``TRAIN_ROWS`` texts of each language (chosen by a hash of the id, the
bound of this classifier) by distributed counts: one packed array of ``BUCKETS`` sums a language reaches the driver.
Every non-null ``lang`` value is learned, however many there are.  Words and languages looked at together are bounded by
``CELLS``: a text with more is labelled in parts, forwards with the state kept at each part's start, then backwards part
by part, with the same result.

Defined cases: where languages are equally likely for a text, the first by name names it; a null text, or one without letters, is ``und`` with score 0, as is everything when no language
can be learned; null languages are not learned; a null ``doc_id`` is not held out; repeated rows are judged
alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwick.llm.common import held_out_by, released, table

UNKNOWN = "und"
TRAIN_ROWS = 2000
BUCKETS = 1 << 16
SWITCH = 6.0
#: A word's evidence for or against a language is bounded by this.
CLIP = 5.0
#: A language uses a script if this share of its letters is of it.
SCRIPT_SHARE = 0.02
#: Words a worker remembers (fewer of many languages); texts taken together; words times languages looked at at once.
CACHE_WORDS, TOGETHER_BYTES, CELLS = 100_000, 6 << 20, 1 << 23
#: Words whose n-grams are looked at in one step.
PART_WORDS = 20_000
#: First code points of scripts; a script reaches to the next entry.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"),
    (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"), (0x3200, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"),
]
NAMES = sorted({name for _, name in SCRIPTS})
WORD = re.compile(r"[^\W\d_]+")
#: Characters beyond Latin letters and common signs: only texts with some can have words of several scripts.
BEYOND_LATIN = re.compile(r"[^\x00-\u036f\u1e00-\u1eff\u2000-\u20cf\ufb00-\ufb1c]").search


def _script_words() -> re.Pattern:
    """Words that end where the script changes."""
    ranges: dict[str, str] = {}
    for (lo, name), hi in zip(SCRIPTS, [x for x, _ in SCRIPTS[1:]] + [0x110000], strict=True):
        ranges[name] = ranges.get(name, "") + f"\\U{lo:08x}-\\U{hi - 1:08x}"
    return re.compile("|".join(f"(?:(?![\\W\\d_])[{r}])+" for r in ranges.values()))


SCRIPT_WORD = _script_words()


def words_of(text: str) -> list[str]:
    """Lower-case words of letters; number signs that count as word characters are no letters."""
    low = text.lower()
    found = (SCRIPT_WORD if not low.isascii() and BEYOND_LATIN(low) else WORD).findall(low)
    if found and not any(c.isalpha() for c in found[0]):
        found = [w for w in found if any(c.isalpha() for c in w)]
    return found


def features(words: list[str]):
    """Bucket of every n-gram (1 to 4 characters of ^word$) and the word it is of; each word's first code point."""
    import numpy as np

    u = np.uint64
    size = np.array([len(w) + 2 for w in words], np.int64)
    code = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), np.uint32).astype(u)
    word = np.repeat(np.arange(len(words)), size)
    buckets, owners = [], []
    h = np.zeros(len(code), u)
    for n in range(1, 5):
        m = len(code) - n + 1
        h = h[:m] * u(0x9E3779B97F4A7C15) + code[n - 1 :] + u(n)
        inside = word[:m] == word[n - 1 :]
        if n == 1:
            inside = inside & (code > 3)
        mixed = (h ^ (h >> u(29))) * u(0xBF58476D1CE4E5B9)
        buckets.append(((mixed >> u(40)) % u(BUCKETS))[inside].astype(np.int64))
        owners.append(word[:m][inside])
    first = code[np.cumsum(size) - size + 1].astype(np.int64)
    return np.concatenate(buckets), np.concatenate(owners), first


def script_of(code_points):
    import numpy as np

    starts = np.array([s for s, _ in SCRIPTS])
    ids = np.array([NAMES.index(n) for _, n in SCRIPTS])
    return ids[np.searchsorted(starts, code_points, side="right") - 1]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse (lang, bucket, n); buckets from BUCKETS on count the letters of a script."""
    import numpy as np

    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = words_of(text)
            if words:
                total = sums.setdefault(lang, np.zeros(BUCKETS + len(NAMES), np.int64))
                for a in range(0, len(words), PART_WORDS):
                    part = words[a : a + PART_WORDS]
                    bucket, _, first = features(part)
                    total += np.bincount(bucket, minlength=len(total))
                    total += np.bincount(BUCKETS + script_of(first), weights=[len(w) for w in part], minlength=len(total)).astype(np.int64)
    for lang, total in sums.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(total[at])], ["lang", "bucket", "n"])


class Model:
    """Languages, their n-gram log shares and the scripts each uses."""

    def __init__(self, langs: list[str], grams, scripts):
        import numpy as np

        self.langs = langs
        share = (grams.astype(np.float64) + 0.5) / (grams.sum(1, keepdims=True, dtype=np.float64) + 0.5 * BUCKETS)
        self.logs = np.ascontiguousarray(np.log(share).T.astype(np.float32))
        used = scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(1, keepdims=True))
        used[:, ~used.any(0)] = True  # a script that no language uses rules none out
        self.barred = ~used.T

    def scores(self, words: list[str]):
        """For each word the bounded log odds of every language against the best."""
        import numpy as np

        if len(words) > PART_WORDS:  # the n-grams of a part are held at once
            return np.concatenate([self.scores(words[a : a + PART_WORDS]) for a in range(0, len(words), PART_WORDS)])
        bucket, owner, first = features(words)
        out = np.zeros((len(words), len(self.langs)), np.float32)
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(owner, weights=self.logs[bucket, k], minlength=len(words))
        out *= 0.5  # n-grams of a word overlap, so they are no independent evidence
        out[self.barred[script_of(first)]] = -np.inf
        return np.maximum(out - out.max(1, keepdims=True), -CLIP)


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> Model | None:
    """From the text and lang of documents that are not held out."""
    import numpy as np

    known = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.col("doc_id").alias("doc_id"))
    known = known.filter(~held_out_by(4, 2)).filter("lang is not null and text is not null")
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = sizes.select("lang", F.least(F.lit(1.0), F.lit(float(rows)) / F.col("n")).alias("share"))
    picked = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 20)) < F.col("share") * (1 << 20)
    taught = known.join(F.broadcast(share), "lang").filter(picked).select("lang", "text")  # a row for each language
    counts = taught.mapInArrow(_counts, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    packed = counts.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("x"))  # BUCKETS entries at most
    got = packed.select("lang", F.col("x.bucket").alias("bucket"), F.col("x.n").alias("n")).orderBy("lang").toArrow()
    langs = got.column(0).to_pylist()
    if not langs:
        return None
    dense = np.zeros((len(langs), BUCKETS + len(NAMES)), np.float32)
    for k in range(len(langs)):
        dense[k, got.column(1)[k].values.to_numpy()] = got.column(2)[k].values.to_numpy()
    return Model(langs, dense[:, :BUCKETS], dense[:, BUCKETS:])


def viterbi(scores, lengths, penalty: float = SWITCH):
    """The best label of every word.  scores: the words' rows, text after text; lengths: words of each text."""
    import numpy as np

    order = np.argsort(-lengths, kind="stable")
    ranked = lengths[order]
    longest = int(ranked[0]) if len(ranked) else 0
    active = np.searchsorted(-ranked, -np.arange(1, longest + 1), side="right")  # texts with more than t words
    begin = (np.cumsum(lengths) - lengths)[order]
    total = int(lengths.sum())
    # rows in the order of time: all first words, all second words, ...
    place = np.concatenate([[0], np.cumsum(active)])
    row = np.concatenate([begin[:a] + t for t, a in enumerate(active.tolist())]) if total else np.zeros(0, np.int64)
    seen = scores[row]
    stay = np.zeros(seen.shape, bool)
    best = np.zeros(len(seen), np.int16)
    state = np.zeros((len(order), scores.shape[1]), np.float32)
    for t, a in enumerate(active.tolist()):
        o = place[t]
        now = state[:a]
        top = now.max(1) - penalty
        np.greater_equal(now, top[:, None], out=stay[o : o + a])
        best[o : o + a] = now.argmax(1)
        np.maximum(now, top[:, None], out=now)
        now += seen[o : o + a]
    label = np.zeros(len(seen), np.int16)
    current = state.argmax(1).astype(np.int16)
    for t in range(longest - 1, -1, -1):
        o, a = place[t], int(active[t])
        label[o : o + a] = current[:a]
        held = stay[np.arange(o, o + a), current[:a]]
        current[:a] = np.where(held, current[:a], best[o : o + a])
    out = np.empty(total, np.int16)
    out[row] = label
    return out


def viterbi_in_parts(parts, scores_of, n_langs: int, penalty: float = SWITCH):
    """The labels of one long text's words, part by part from the last one: the same as of viterbi.

    parts: the text's words in parts; scores_of(words) gives their scores.
    """
    import numpy as np

    def forward(scores, state):
        stay, best = np.zeros(scores.shape, bool), np.zeros(len(scores), np.int16)
        for t, seen in enumerate(scores):
            top = state.max() - penalty
            stay[t], best[t] = state >= top, state.argmax()
            state = np.maximum(state, top) + seen
        return stay, best, state

    state, starts = np.zeros(n_langs, np.float32), []
    for part in parts:
        starts.append(state)
        state = forward(scores_of(part), state)[2]
    current = int(state.argmax())
    for part, start in zip(reversed(parts), reversed(starts), strict=True):
        scores = scores_of(part)
        stay, best, _ = forward(scores, start)
        label = np.zeros(len(part), np.int64)
        for t in range(len(part) - 1, -1, -1):
            label[t] = current
            if not stay[t, current]:
                current = int(best[t])
        yield label, scores


class Judge:
    """Labels texts with a model; a worker's memory of the words it has scored."""

    def __init__(self, model: Model | None):
        import numpy as np

        self.model, self.known, self.size = model, {}, 0
        self.rows = np.zeros((0, len(model.langs) if model else 0), np.float32)

    def _numbers(self, words: list[str]):
        import numpy as np

        found = list(map(self.known.get, words))
        if None in found:
            new = list(dict.fromkeys(w for w, k in zip(words, found, strict=True) if k is None))
            got, end = self.model.scores(new), self.size + len(new)
            if end > len(self.rows):
                self.rows = np.concatenate([self.rows[: self.size], np.zeros((max(len(new), 50_000), got.shape[1]), np.float32)])
            self.rows[self.size : end] = got
            self.known.update(zip(new, range(self.size, end), strict=True))
            self.size = end
            found = list(map(self.known.__getitem__, words))
        return np.array(found, np.int64)

    def judge(self, texts: list[str | None], spans: bool = False):
        """Language, score and spans (lang, words lo to hi) of each text."""
        import numpy as np

        n, m = len(texts), self.model
        lang, score, runs = [UNKNOWN] * n, np.zeros(n), [[] for _ in range(n)]
        if not m:
            return lang, score, runs
        most = max(1, CELLS // len(m.langs))
        held, words, size = [], [], 0
        for k in range(n + 1):
            found = words_of(texts[k] or "") if k < n else []
            if held and (k == n or size + len(found) > most):
                some_lang, some_score, some_runs = self._judged(words, spans, most)
                for j, a, b, c in zip(held, some_lang, some_score, some_runs, strict=True):
                    lang[j], score[j], runs[j] = a, b, c
                held, words, size = [], [], 0
            if found:
                held.append(k)
                words.append(found)
                size += len(found)
        return lang, score, runs

    def _scores(self, words: list[str]):
        if len(self.known) > min(CACHE_WORDS, max(10_000, CELLS // len(self.model.langs))):
            self.known.clear()
            self.size = 0
        numbers = self._numbers(words)  # may replace the table
        return self.rows[numbers]

    @staticmethod
    def _odds(scores, label):
        import numpy as np

        return np.exp(scores[np.arange(len(label)), label]) / np.exp(scores).sum(1)

    def _judged(self, words: list[list[str]], spans: bool, most: int):
        """Of texts with words that hold ``most`` words together, or of one that holds more."""
        import numpy as np

        m, n, k = self.model, len(words), len(self.model.langs)
        lengths = np.array([len(w) for w in words], np.int64)
        flat = words[0] if n == 1 else [w for ws in words for w in ws]
        if len(flat) <= most:
            scores = self._scores(flat)
            label = viterbi(scores, lengths).astype(np.int64)
            odds = self._odds(scores, label)
        else:
            parts = [flat[a : a + most] for a in range(0, len(flat), most)]
            done = [(label, self._odds(scores, label)) for label, scores in viterbi_in_parts(parts, self._scores, k)][::-1]
            label, odds = (np.concatenate(x) for x in zip(*done, strict=True))
        letters = np.fromiter(map(len, flat), np.int64, len(flat))
        text = np.repeat(np.arange(n), lengths)
        each = np.bincount(text * k + label, weights=letters, minlength=n * k).reshape(n, k)
        top = each.argmax(1)
        mine = label == top[text]
        weight = np.bincount(text[mine], weights=letters[mine], minlength=n)
        sure = np.bincount(text[mine], weights=(odds * letters)[mine], minlength=n) / np.maximum(1, weight)
        score = np.minimum(1.0, each.max(1) / np.maximum(1, each.sum(1)) * sure)
        runs: list[list[dict]] = [[] for _ in range(n)]
        if spans:
            cut = np.flatnonzero(np.concatenate([[True], (label[1:] != label[:-1]) | (text[1:] != text[:-1])])).tolist()
            first = (np.cumsum(lengths) - lengths).tolist()
            for a, b in zip(cut, [*cut[1:], len(label)], strict=True):
                t = int(text[a])
                runs[t].append({"lang": m.langs[label[a]], "lo": a - first[t], "hi": b - first[t]})
        return [m.langs[x] for x in top.tolist()], score.tolist(), runs


def together(batches: Iterator[pa.RecordBatch], text_at: int, most: int = TOGETHER_BYTES) -> Iterator[list[pa.RecordBatch]]:
    """Batches in groups of about so many bytes of text: a Viterbi pass takes as many steps as its longest text."""
    held, weight = [], 0
    for batch in batches:
        held.append(batch)
        weight += batch.column(text_at).nbytes
        if weight >= most:
            yield held
            held, weight = [], 0
    if held:
        yield held


def _predict(model, spans: bool):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model.value)
        for held in together(batches, 2):
            lang, score, runs = judge.judge([t for b in held for t in b.column(2).to_pylist()], spans)
            out = [pa.concat_arrays([b.column(k) for b in held]) for k in (0, 1)] + [pa.array(lang, pa.string()), pa.array(score)]
            names = ["doc_id", "held_out", "lang_pred", "score"]
            if spans:
                out.append(pa.array(runs, pa.list_(pa.struct([("lang", pa.string()), ("lo", pa.int32()), ("hi", pa.int32())]))))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(out, names)

    return run


def predict(docs: DataFrame, model: Model | None, spans: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score and, if asked for, spans (lang, words lo to hi) of every row."""
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out_by(4, 2).alias("held_out"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    if spans:
        schema += ", spans array<struct<lang:string,lo:int,hi:int>>"
    return cols.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model), spans), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs))
