"""Language identification by hierarchical discrimination.

First the language family is predicted, by one linear SVM per family against the rest; then one-versus-one linear
SVMs separate the languages within it.  Features are the distinct hashed character 1- to 4-grams of the whole
lower-cased text, scaled to unit length.  The machines are fitted on at most ``SAMPLE`` rows with a language, in
equal shares per language, drawn by a hash of doc_id and text; every text is judged whole.

``keep_identified`` keeps a text if its score reaches a bound, which is calibrated on learned rows: machines fitted on
three quarters of them judge the last quarter, and the bound lies below practically all of these scores, the further
the fewer they are; with a single learned language every score is 1.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; null languages are never learned; a
family with one language needs no second step; with no learned language everything is ``und``, but
``keep_identified`` keeps all texts with a letter; repeated documents
are judged per row; an empty table gives no row; other columns are never read.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealscope.llm import common, sampling
from dealscope.llm.linear import Distinct, fit, presence, sigmoid

ORDERS = (1, 2, 3, 4)
BITS = 16
#: Bound of the rows that the machines are fitted on.
SAMPLE = 4000
#: Every so many-th row of a language is held out to calibrate the bound.
HOLD = 4
#: The bound: this part of the log-odds of the score that all but LOST of the held rows reach, less WIDEN / (rows + 1).
LOST, SLACK, WIDEN = 0.001, 0.6, 20.0
UNDETERMINED = "und"
#: Families of common languages; any other value is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"),
    "uralic": ("fi", "et", "hu"), "turkic": ("tr", "az", "kk", "uz"), "semitic": ("ar", "he", "mt"),
    "indic": ("hi", "bn", "ur", "pa", "mr", "gu", "ne"), "iranian": ("fa", "ku", "ps"), "baltic": ("lt", "lv"),
}
LETTER = regex.compile(r"\p{L}")


def family_of(lang: str) -> str:
    code = lang.lower().replace("_", "-").split("-")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes), lang)


def fit_machines(labels: list, ids: np.ndarray, offsets: np.ndarray, least: float = 0.0) -> bytes:
    """A JSON head (families, machines, bound of the score) and one row of float32 weights and bias per machine."""
    langs = sorted(set(labels))
    family = np.array([family_of(x) for x in labels])
    lang = np.array(labels)
    families = {f: [x for x in langs if family_of(x) == f] for f in sorted({family_of(x) for x in langs})}
    sizes = np.diff(offsets)
    unit = 1 / np.sqrt(np.maximum(sizes, 1))  # every entry of a row has this value
    machines, weights = [], []

    def add(kind: list, rows: np.ndarray, positive: np.ndarray) -> None:
        cuts = np.concatenate(([0], np.cumsum(sizes[rows])))
        y = np.where(positive[rows], 1.0, -1.0)
        balance = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
        own = ids if rows.all() else ids[np.repeat(rows, sizes)]
        w, b = fit(own, cuts, None, y, balance, 1 << BITS, "hinge2", l2=1e-5, steps=60, rate=0.1, scale=unit[rows])
        machines.append(kind)
        weights.append(np.append(w, b))

    if len(families) > 1:
        for f in families if len(families) > 2 else list(families)[:1]:
            add(["family", f], np.ones(len(sizes), bool), family == f)
    for members in families.values():
        for a, b in combinations(members, 2):
            add(["pair", a, b], (lang == a) | (lang == b), lang == a)
    head = json.dumps({"families": families, "machines": machines, "least": least}).encode()
    body = np.array(weights, dtype="<f4").tobytes()
    return len(head).to_bytes(4, "little") + head + body


def fit_calibrated(labels: list, ids: np.ndarray, offsets: np.ndarray) -> bytes:
    """Machines fitted on all rows, with the bound that machines fitted without the held rows give."""
    seen, held = Counter(), np.zeros(len(labels), bool)
    for i, label in enumerate(labels):
        seen[label] += 1
        held[i] = seen[label] % HOLD == 0
    odds, n = 0.0, int(held.sum())
    if n:
        sizes = np.diff(offsets)
        judge = Judge(fit_machines([x for x, h in zip(labels, held, strict=True) if not h], ids[np.repeat(~held, sizes)],
                                   np.concatenate(([0], np.cumsum(sizes[~held])))))
        scores = np.array([judge.of(ids[offsets[i]:offsets[i + 1]])[1] for i in np.flatnonzero(held)])
        low = np.clip(np.quantile(scores, LOST, method="lower"), 1e-9, 1 - 1e-9)
        odds = np.log(low / (1 - low))
    return fit_machines(labels, ids, offsets, sigmoid(min(SLACK * odds, odds) - WIDEN / (n + 1)))


class Judge:
    def __init__(self, model: bytes) -> None:
        n = int.from_bytes(model[:4], "little")
        head = json.loads(model[4:4 + n])
        self.families, self.least, machines = head["families"], head["least"], [tuple(m) for m in head["machines"]]
        weights = np.frombuffer(model[4 + n:], "<f4").reshape(len(machines), -1) if machines else np.zeros((0, 1))
        self.weights = np.ascontiguousarray(weights[:, :-1].T, dtype=np.float32)
        self.bias = weights[:, -1].astype(np.float64)
        self.at = {m: i for i, m in enumerate(machines)}
        self.distinct = Distinct(BITS)

    def __call__(self, text: str) -> tuple[str, float]:
        if not self.families or not LETTER.search(text):
            return UNDETERMINED, 0.0
        return self.of(presence(text.lower(), ORDERS, BITS, self.distinct))

    def keeps(self, text: str, least: float) -> bool:
        if not self.families:
            return LETTER.search(text) is not None
        lang, score = self(text)
        return lang != UNDETERMINED and score >= least

    def of(self, ids: np.ndarray) -> tuple[str, float]:
        margin = self.weights[ids].sum(axis=0, dtype=np.float64) / np.sqrt(max(1, len(ids))) + self.bias
        names = list(self.families)
        if len(names) == 1:
            best, sure = names[0], 1.0
        elif len(names) == 2:
            m = margin[self.at["family", names[0]]]
            best, sure = names[0] if m >= 0 else names[1], sigmoid(2 * abs(m))
        else:
            m = np.array([margin[self.at["family", f]] for f in names])
            best, sure = names[int(m.argmax())], sigmoid(2 * m.max())
        members = self.families[best]
        votes, least = dict.fromkeys(members, 0.0), dict.fromkeys(members, 1.0)
        for a, b in combinations(members, 2):
            p = sigmoid(2 * margin[self.at["pair", a, b]])
            votes[a] += (p >= 0.5) + 1e-3 * p
            votes[b] += (p < 0.5) + 1e-3 * (1 - p)
            least[a], least[b] = min(least[a], p), min(least[b], 1 - p)
        lang = max(members, key=lambda x: (votes[x], x))
        return lang, sure * least[lang]


def learn(docs: DataFrame, keep: Column, sample: int = SAMPLE,
          fitter: Callable[[list, np.ndarray, np.ndarray], bytes] = fit_machines) -> bytes:
    """The machines, from the documents with a language for which ``keep`` holds."""
    known = docs.where(keep & F.col("lang").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("label"),
        F.col("text").cast("string").alias("text"))
    sizes = known.groupBy("label").count().collect()  # one row per language
    share = {r["label"]: min(1.0, sample / len(sizes) / r["count"]) for r in sizes}
    if not share:
        return fit_machines([], np.zeros(0, np.int32), np.zeros(1, np.int64))
    lookup = F.create_map(*[x for k, v in share.items() for x in (F.lit(k), F.lit(v))])
    # a repeated row counts once, so that the draw stays bounded whatever repeats
    rows = known.where(sampling.draw(lookup[F.col("label")], "text")).distinct().select("label", "text")
    return sampling.train(sampling.features(rows, ORDERS, BITS, lower=True), fitter)


def predict(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, lang_pred, score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        for batch in common.text_slices(batches):
            out = [judge(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in out]), pa.array([x[1] for x in out], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, fold: int = 4, held: int = 2, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score; rows whose id's checksum is ``held`` modulo ``fold`` are not learned from."""
    model = learn(docs, sampling.remainder(fold) != held, sample)
    return predict(docs, model).select("doc_id", (sampling.remainder(fold) == held).alias("held_out"), "lang_pred",
                                       "score")


def keep_identified(docs: DataFrame, least: float | None = None, sample: int = SAMPLE) -> DataFrame:
    """The documents whose language can be told: not ``und`` and a score of at least ``least`` or the calibrated bound."""
    lettered = F.col("text").cast("string").rlike(r"\p{L}")
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, lettered, sample, fit_calibrated))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        bound = judge.least if least is None else least
        for batch in common.row_slices(batches):
            text = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([judge.keeps(t or "", bound) for t in text], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
