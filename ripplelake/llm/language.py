"""Language identification in two steps: the family first, then one-versus-one linear support vector machines among its languages.

Features are the 1 to 4 letter sequences of each word with its two ends marked, hashed into 2^15 places; words are runs of letters, lower-cased.
A family model tells a family from all others; in the family with the largest margin, a machine for each two of its
languages casts a vote, and the language with the most votes wins, then the one with the larger margins, then the first by name.
A family of one language needs no machine.  All machines are trained by dual coordinate descent without a bias, so only the
sign of a sum of weights counts, and a text of any length is the sum of its words.

Fitting is bounded by documented parameters: the ``languages`` most frequent values of ``lang``, and ``sample_rows`` rows in all, the same
number of each language, those with the smallest hash of their doc_id.  Family models are trained in one task, the machines of each
family in one of their own.  Every whole text is predicted.

The score is the margin of the family model and the mean margin of the winner's machines, each as a share of the margin if all words agreed,
moved to 0 to 1 and multiplied.

Nulls: a null text, like one without a letter, is ``und`` with score 0; so is every text if nothing was learned.  Rows with a null doc_id or
lang are not learned from; ``held_out`` is false without a doc_id.  Long texts are read piece by piece.  An empty table gives no row.  Repeated
rows are predicted alike.  Columns other than ``doc_id, text, lang`` are not read, and ``lang`` only to learn.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
PLACES, LONGEST = 15, 4
#: Bounds of the fit.
LANGUAGES, SAMPLE = 200, 8_000
ROUNDS, COST = 10, 1.0
#: Numbers remembered per worker for words that were met before.
REMEMBERED = 8_000_000
#: Letters, and number signs other than digits, which are taken out again.
RUN = re.compile(r"[^\W\d_]+")

# Families of languages by ISO 639-1 code.  A code that stands nowhere is a family of its own.
FAMILIES = {
    "Germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "Romance": "ca es fr gl it la oc pt ro",
    "Slavic": "be bg bs cs hr mk pl ru sh sk sl sr uk",
    "Baltic": "lt lv",
    "Celtic": "br cy ga gd",
    "Indo-Aryan": "as bn gu hi mr ne or pa sa sd si ur",
    "Iranian": "fa ku ps tg",
    "Uralic": "et fi hu",
    "Turkic": "az ba kk ky tk tr tt ug uz",
    "Semitic": "am ar he mt",
    "Dravidian": "kn ml ta te",
    "Austronesian": "id jv mg ms su tl",
    "Bantu": "rw sn st sw xh zu",
}


def family_of(lang: str) -> str:
    code = re.split("[-_]", lang.strip().lower())[0]
    return next((name for name, codes in FAMILIES.items() if code in codes.split()), f"only {lang}")


# Features


def runs(text: str, size: int = 1 << 20) -> Iterator[list[str]]:
    """The words of a text, of a long one in parts cut between words."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text) and (rest := RUN.match(text, end)):
            end = rest.end()
        words = RUN.findall(text[at:end].lower())
        if not all(map(str.isalpha, words)):
            words = ["".join(filter(str.isalpha, w)) for w in words]
        yield [w for w in words if w]
        at = end


def places(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the sequences of all these words, and the number of the word each belongs to."""
    points = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    end = points == 32
    word = np.cumsum(end) - 1
    found, owners = [], []
    code, crosses = np.zeros(len(points), np.uint64), np.zeros(len(points), bool)
    for n in range(1, LONGEST + 1):
        code = code[: len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1 :]
        if n > 2:
            crosses = crosses[: len(points) - n + 1] | end[n - 2 : len(points) - 1]  # an end may only be first or last
        kept = ~crosses[: len(code)] & (~end[: len(code)] if n == 1 else ~(end[: len(code)] & end[n - 1 :]) | (n > 2))
        mixed = (code[kept] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        found.append((mixed >> np.uint64(64 - PLACES)).astype(np.int32))
        # A sequence that begins with the end of a word belongs to the word after it.
        owners.append(word[: len(code)][kept])
    return np.concatenate(found), np.concatenate(owners)


def profile(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places of a text and how often each occurs."""
    total = np.zeros(1 << PLACES, np.int64)
    for words in runs(text):
        if words:
            total += np.bincount(places(words)[0], minlength=1 << PLACES)
    at = np.flatnonzero(total)
    return at.astype(np.int32), total[at].astype(np.float32)


# Learning


def machine(rows: list[tuple[np.ndarray, np.ndarray]], positive: np.ndarray) -> np.ndarray:
    """Weights of a linear support vector machine by dual coordinate descent; both sides have the same total cost."""
    y = np.where(positive, 1.0, -1.0)
    cost = COST * len(rows) / 2 / np.where(positive, max(positive.sum(), 1), max((~positive).sum(), 1))
    w, alpha = np.zeros(1 << PLACES), np.zeros(len(rows))
    rng = np.random.default_rng(1)
    for _ in range(ROUNDS):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            step = np.clip(alpha[i] - (y[i] * (w[at] @ x) - 1), 0, cost[i]) - alpha[i]
            if step:
                alpha[i] += step
                w[at] += step * y[i] * x
    return w


def learn(part: pd.DataFrame, classes: list[str], labels: list[str], duels: bool) -> list[tuple[str, str, list[float]]]:
    """``(one, other, weights)``: each class against each other one, or against all others."""
    rows = [(np.asarray(at, np.int64), np.asarray(n, float)) for at, n in zip(part.pop("at"), part.pop("n"))]
    mean = np.full(1 << PLACES, 1e-6)
    for at, n in rows:
        mean[at] += n / n.sum() / len(rows)
    scale = 1 / np.sqrt(mean)  # rare sequences count for more
    rows = [(at, n * scale[at] / np.linalg.norm(n * scale[at])) for at, n in rows]
    label, found = np.array(labels, object), []
    for one, other in combinations(classes, 2) if duels else [(c, "") for c in classes]:
        among = np.flatnonzero((label == one) | (label == other)) if duels else np.arange(len(rows))
        found.append((one, other, (machine([rows[i] for i in among], label[among] == one) * scale).tolist()))
    return found


class Model:
    """Languages, their families, and a column of weights per family and per two languages of one."""

    def __init__(self, languages: list[str], found: list[tuple[str, str, list[float]]]):
        self.members: dict[str, list[str]] = {}
        for lang in sorted(languages):
            self.members.setdefault(family_of(lang), []).append(lang)
        self.families = sorted(self.members)
        at = {(one, other): i for i, (one, other, _) in enumerate(found)}
        self.columns = [at.get((f, "")) for f in self.families]
        self.duels = {f: [(a, b, at[a, b]) for a, b in combinations(m, 2)] for f, m in self.members.items()}
        # float32, a row per place: 2^15 x (families + pairs) x 4 bytes
        self.weights = np.array([w for _, _, w in found], np.float32).T.copy() if found else np.zeros((1 << PLACES, 0), np.float32)

    def decide(self, total: np.ndarray, size: np.ndarray) -> tuple[str, float]:
        """From the sums of the words' weights and of their sizes."""
        margin = total / np.maximum(size, 1e-30)
        family, score = self.families[0], 1.0
        if len(self.families) > 1:
            i = int(np.argmax(total[self.columns]))
            family, score = self.families[i], (1 + margin[self.columns[i]]) / 2
        members = self.members[family]
        if len(members) == 1:
            return members[0], float(np.clip(score, 0, 1))
        votes, sums = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
        for a, b, i in self.duels[family]:
            votes[a if margin[i] >= 0 else b] += 1
            sums[a] += margin[i]
            sums[b] -= margin[i]
        best = min(members, key=lambda m: (-votes[m], -sums[m], m))
        share = (1 + sums[best] / (len(members) - 1)) / 2
        return best, float(np.clip(score * share, 0, 1))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, languages: int = LANGUAGES, sample_rows: int = SAMPLE) -> Model:
    """Fitted on rows that are not held out.  Only names and weights come to the driver."""
    known = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(~held_out())
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    names = [r["lang"] for r in counts]
    if not names:
        return Model([], [])
    # A bound on the hash lets through little more than the rows wanted, however many a language has; the smallest of them stay.
    each = max(sample_rows // len(names), 1)
    enough = each + 6 * each**0.5 + 20
    let_in = F.lit(False)
    for r in counts:
        bound = 2**62 if r["n"] <= enough else int(2**62 * enough / r["n"])
        let_in = let_in | ((F.col("lang") == r["lang"]) & (F.col("order") <= bound))
    order = F.xxhash64("doc_id").bitwiseAND(2**62 - 1)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id"))
    some = (
        known.select("lang", "doc_id", order.alias("order")).where(let_in)
        .withColumn("place", place).where(F.col("place") <= each).select("lang", "doc_id")
    )
    # sample_rows short rows, which the texts are joined with where they lie
    sample = known.select("lang", "doc_id", "text").join(F.broadcast(some.distinct()), ["lang", "doc_id"])

    def describe(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for lang, doc_id, text in zip(part["lang"], part["doc_id"], part["text"]):
                at, n = profile(text)
                if len(at):
                    yield pd.DataFrame({"group": ["", family_of(lang)], "lang": lang, "doc_id": doc_id, "at": [at] * 2, "n": [n] * 2})

    def teach(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["lang", "doc_id"]).drop_duplicates(["lang", "doc_id"])
        labels = part["lang"].tolist() if key[0] else [family_of(x) for x in part["lang"]]
        classes = sorted(set(labels))
        found = learn(part, classes, labels, bool(key[0])) if len(classes) > 1 else []
        return pd.DataFrame(found, columns=["one", "other", "weights"])

    described = sample.mapInPandas(describe, "group string, lang string, doc_id long, at array<int>, n array<float>")
    met = described.groupBy("group").applyInPandas(teach, "one string, other string, weights array<float>").collect()
    return Model(names, sorted((r["one"], r["other"], r["weights"]) for r in met))


# Prediction


class Reader:
    """Adds up the weights of a text's words; words met before are looked up."""

    def __init__(self, model: Model):
        self.model, self.width = model, model.weights.shape[1]
        self.most = max(REMEMBERED // max(self.width, 1), 1000)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.sums = np.zeros((1024, self.width), np.float32)

    def meet(self, words: list[str]) -> None:
        new = [w for w in set(words) if w not in self.known]
        if not new:
            return
        if len(self.known) + len(new) > self.most:
            self.forget()
            new = list(set(words))
        start, need = len(self.known), len(self.known) + len(new)
        if need > len(self.sums):
            more = np.zeros((max(need, 2 * len(self.sums)), self.width), np.float32)
            more[:start] = self.sums[:start]
            self.sums = more
        at, owner = places(new)
        for m in range(self.width):
            self.sums[start:need, m] = np.bincount(owner, self.model.weights[at, m], len(new))[: len(new)]
        self.known.update(zip(new, range(start, need)))

    def __call__(self, text: str | None) -> tuple[str, float]:
        total, size, any_word = np.zeros(self.width), np.zeros(self.width), False
        for words in runs(text or ""):
            if words:
                any_word = True
                self.meet(words)
                each = self.sums[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]
                total += each.sum(0)
                size += np.abs(each).sum(0)
        if not any_word or not self.model.members:
            return UNKNOWN, 0.0
        return self.model.decide(total, size)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most 2^15 weights per family and pair of the fixed list

    def read(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(sent.value)
        for column in columns:
            yield pd.DataFrame([reader(t) for t in column], columns=["lang_pred", "score"])

    found = F.pandas_udf(read, "lang_pred string, score double")
    return docs.select("doc_id", held_out().alias("held_out"), found("text").alias("found")).select(
        "doc_id", "held_out", "found.lang_pred", "found.score"
    )


def report(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs))
