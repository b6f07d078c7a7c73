"""Guarded, de-duplicated batch inference.

A *stage* produces one column from a prompt.  Two backends:

* ``rule`` (default): a deterministic stand-in written as Catalyst
  expressions (summarise = the densest runs of words, classify = keyword hits over a
  closed label set, generate = template fill).  No Python in the plan, no
  shuffle, fully oracle-checkable.
* a Python callable ``fn(list[str]) -> list[str | None]`` (or a factory
  returning one, built once per partition): prompts are collected per
  stage level into one long table, de-duplicated by ``sha2``, sent through
  a single ``mapInPandas`` in Arrow batches, checkpointed (so a lost
  executor or a retry never repeats a paid call) and joined back.

Guards never rely on ``CASE WHEN`` short-circuiting a Python call: a row
whose guard is false gets a NULL prompt and is never sent.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealscope.functions.text import bind, tokens, words
from dealscope.session import ensure_checkpoint_dir, freed_shuffles

# ---------------------------------------------------------------------------
# Rule backend primitives
# ---------------------------------------------------------------------------


RUN = 10  # words per run of the extractive summary


def rule_summarize(content: Column, max_words: int) -> Column:
    """Extractive stand-in over the whole content: its words are cut into runs
    of ``RUN``; the runs with most distinct long words (5 characters or more;
    ties -> earlier run) are kept, in text order, up to ``max_words`` words.
    A content of at most ``max_words`` words is its own summary."""
    def run(w: Column, i: Column) -> Column:
        return F.slice(w, i * RUN + 1, F.lit(RUN))

    def chosen(w: Column, lower: Column) -> Column:
        last = F.floor((F.size(w) - 1) / F.lit(RUN)).cast("int")
        scored = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
            (-F.size(F.array_distinct(F.filter(run(lower, i), lambda x: F.length(x) >= 5)))).alias("rank"), i.alias("at")))
        best = F.transform(F.slice(F.array_sort(scored), 1, max_words // RUN), lambda r: r["at"])
        return F.flatten(F.transform(F.array_sort(best), lambda i: run(w, i)))

    def pick(text: Column, w: Column) -> Column:
        # the whole text is lowered at once, and only where there is more than one run to choose from
        return F.array_join(F.when(F.size(w) <= max_words, w).otherwise(
            bind(words(F.lower(text)), lambda lower: chosen(w, lower))), " ")
    return bind(content, lambda text: bind(words(text), lambda w: pick(text, w)))


def rule_classify(content: Column, labels: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Closed-set classifier: the label with most distinct keyword hits
    (ties -> earlier label), NULL when nothing matches.  One projection.

    The text's tokens are intersected once with the whole vocabulary (one
    hash-set pass over the text); the per-label counts then work on that
    handful of matched keywords only."""
    vocab = sorted({w for _, kws in labels for w in kws})
    if not vocab:
        return F.lit(None).cast("string")
    matched = F.array_intersect(tokens(content), F.array(*[F.lit(w) for w in vocab]))

    def best_of(m: Column) -> Column:
        def hits(kws):
            if not kws:
                return F.lit(0)
            return F.size(F.array_intersect(m, F.array(*[F.lit(w) for w in kws])))
        return F.array_max(F.array(*[
            F.struct(hits(kws).alias("hits"), F.lit(-i).alias("rank"), F.lit(label).alias("label"))
            for i, (label, kws) in enumerate(labels)]))
    # bind(): the text is tokenised once per row even under a guard.
    return bind(bind(matched, best_of), lambda b: F.when(b["hits"] > 0, b["label"]))


# ---------------------------------------------------------------------------
# Stage description
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Stage:
    """One enrichment column.

    ``guard``: rows where it is false get ``otherwise`` and are never sent.
    ``prompt``: full prompt for a model backend.  ``rule``: stand-in answer.
    ``default``: replaces a NULL / failed answer.  ``post``: wraps the answer
    (e.g. a fixed prefix) after the default.
    """

    name: str
    prompt: Column
    rule: Column
    guard: Column | None = None
    otherwise: Column | None = None
    default: str | None = None
    post: Callable[[Column], Column] | None = None
    #: Closed label set: any other answer counts as none.
    labels: tuple[str, ...] | None = None
    #: Model options as (name, value) pairs, e.g. max_tokens, temperature, top_p.
    options: tuple[tuple[str, float], ...] = ()

    def finish(self, answer: Column) -> Column:
        if self.labels is not None:
            answer = F.when(answer.isin(*self.labels), answer)
        out = answer if self.default is None else F.coalesce(answer, F.lit(self.default))
        if self.post is not None:
            out = self.post(out)
        if self.guard is not None:
            out = F.when(self.guard, out).otherwise(self.otherwise)
        return out

    def guarded_prompt(self) -> Column:
        if self.guard is None:
            return self.prompt
        return F.when(self.guard, self.prompt)


Backend = str | Callable


def apply_level(df: DataFrame, key: str, stages: Sequence[Stage], backend: Backend = "rule",
                batch_size: int = 64, partitions: int | None = None,
                max_failure_rate: float | None = None, cache: AnswerCache | None = None) -> DataFrame:
    """Add every stage of one dependency level to ``df``.

    With a model backend the level's answers (key and one column per stage)
    are written by a reliable checkpoint, so a level adds one scan and one
    join to the plan, whatever came before it.  ``max_failure_rate``: share
    of failed calls beyond which the run stops before anything is written."""
    if backend == "rule":
        return df.withColumns({s.name: s.finish(s.rule) for s in stages})
    ensure_checkpoint_dir(df.sparkSession)
    answers = infer_long(df, key, {s.name: s.guarded_prompt() for s in stages}, backend, cache=cache,
                         batch_size=batch_size, partitions=partitions, max_failure_rate=max_failure_rate,
                         options={s.name: dict(s.options) for s in stages if s.options})
    tmp = {s.name: "__ans_" + s.name for s in stages}
    wide = _stored(answers.groupBy(key)
                   .agg(*[F.max(F.when(F.col("stage") == s.name, F.col("answer"))).alias(tmp[s.name])
                          for s in stages]))
    out = df.join(wide, key, "left")
    out = out.withColumns({s.name: s.finish(F.col(tmp[s.name])) for s in stages})
    return out.drop(*tmp.values())


# ---------------------------------------------------------------------------
# Callable backend
# ---------------------------------------------------------------------------


def _stored(df: DataFrame) -> DataFrame:
    """A reliable checkpoint whose shuffle files go when it is written."""
    with freed_shuffles(df.sparkSession):
        # Spark notes the setting when a DataFrame is made, so the one that is stored is made in here
        return df.select("*").checkpoint(eager=True)


def _resolve(fn_or_factory):
    fn = fn_or_factory
    if getattr(fn_or_factory, "is_factory", False):
        fn = fn_or_factory()
    return fn


def model_factory(factory: Callable[[], Callable[[list[str]], list]]):
    """Mark ``factory`` as building the model function once per partition
    (e.g. to open a client connection)."""
    factory.is_factory = True
    return factory


def takes_options(fn: Callable) -> Callable:
    """Mark a model function that is called as ``fn(prompts, options)``."""
    fn.takes_options = True
    return fn


def _call_batches(fn_or_factory, batch_size: int):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = _resolve(fn_or_factory)

        def ask(prompts: list[str], options: str) -> list:
            res = list(fn(prompts, json.loads(options)) if getattr(fn, "takes_options", False) else fn(prompts))
            if len(res) != len(prompts):
                raise ValueError("model returned a different number of answers")
            return res

        for pdf in it:
            out, failed = {}, {}
            for options, part in pdf.groupby("options", sort=False):
                rows = list(zip(part.index, part["prompt"], strict=True))
                for i in range(0, len(rows), batch_size):
                    chunk = rows[i:i + batch_size]
                    try:
                        answers = [(a, False) for a in ask([p for _, p in chunk], options)]
                    except Exception:  # noqa: BLE001 - failure of one batch: retry per prompt
                        answers = []
                        for _, p in chunk:
                            try:
                                answers.append((ask([p], options)[0], False))
                            except Exception:  # noqa: BLE001 - flagged; NULL -> stage default
                                answers.append((None, True))
                    for (at, _), (answer, bad) in zip(chunk, answers, strict=True):
                        out[at], failed[at] = None if answer is None else str(answer), bad
            yield pd.DataFrame({"h": pdf["h"], "answer": pd.Series(out, dtype=object).reindex(pdf.index),
                                "failed": pd.Series(failed, dtype=bool).reindex(pdf.index)})
    return run


class AnswerCache:
    """Answers of earlier runs, by prompt hash (options included), model and prompt version.

    ``path`` is a shared folder; a level's new answers are appended to the
    partition of their model and prompt version as one folder of files.  What
    a run knows is looked up with one join by hash, and what it does not know
    with a left-anti join, so only unknown prompts are sent.  Appending is
    idempotent: should an answer be stored twice (a run that was started
    again), look-ups take one, always the same.  Failed calls are not stored.
    """

    SCHEMA = "h string, answer string, run string, model string, prompt_version string"

    def __init__(self, spark: SparkSession, path: str, model: str, prompt_version: str, run: str | None = None):
        self.spark, self.path, self.model, self.prompt_version = spark, path.rstrip("/"), model, prompt_version
        self.run = run or uuid.uuid4().hex

    def known(self) -> DataFrame:
        """h, answer and run of this model and prompt version, one row per hash."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], self.SCHEMA).select("h", "answer", "run")
        rows = self.spark.read.schema(self.SCHEMA).parquet(self.path).where(
            (F.col("model") == self.model) & (F.col("prompt_version") == self.prompt_version))
        return rows.groupBy("h").agg(F.min(F.struct("run", "answer")).alias("a")).select("h", "a.answer", "a.run")

    def answers(self, uniq: DataFrame, ask: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``(h, answer, failed)`` of the distinct prompts: the known ones from
        the store, the others from ``ask``, whose answers are stored first."""
        ensure_checkpoint_dir(self.spark)
        known = self.known().select("h", "answer")
        found = uniq.select("h").join(known, "h").withColumn("failed", F.lit(False))
        new = _stored(ask(uniq.join(known.select("h"), "h", "left_anti")))  # paid once, stored next
        answers = _stored(found).unionByName(new)  # before the store grows
        with freed_shuffles(self.spark):
            (new.where(~F.col("failed")).select("h", "answer", F.lit(self.run).alias("run"), F.lit(self.model).alias("model"),
                                                 F.lit(self.prompt_version).alias("prompt_version"))
             .hint("rebalance").write.mode("append").partitionBy("model", "prompt_version").parquet(self.path))
        return answers


def distinct_prompts(df: DataFrame, key: str, prompts: dict[str, Column],
                     options: dict[str, dict] | None = None) -> tuple[DataFrame, DataFrame]:
    """Long table ``(key, stage, h, prompt)`` and its distinct non-NULL
    prompts ``(h, prompt, options)``; prompts with other options differ.  NULL prompts get a per-row sentinel hash so
    they never meet in one join partition (no skew from guarded rows)."""
    given = {n: json.dumps((options or {}).get(n, {}), sort_keys=True) for n in prompts}
    stacked = F.inline(F.array(*[F.struct(F.lit(n).alias("stage"), p.alias("prompt"), F.lit(given[n]).alias("options"))
                                 for n, p in prompts.items()]))
    long = df.select(F.col(key), stacked)
    asked = F.when(F.col("options") == "{}", F.col("prompt")).otherwise(F.concat("options", "prompt"))
    h = F.coalesce(F.sha2(asked, 256), F.concat(F.lit("~"), F.col("stage"), F.lit("~"), F.col(key)))
    long = long.withColumn("h", h)
    uniq = long.where(F.col("prompt").isNotNull()).select("h", "prompt", "options").distinct()  # hash aggregate, no buffers
    return long, uniq


def infer_long(df: DataFrame, key: str, prompts: dict[str, Column], fn, batch_size: int = 64,
               partitions: int | None = None, checkpoint: bool = True, options: dict[str, dict] | None = None,
               max_failure_rate: float | None = None, cache: AnswerCache | None = None) -> DataFrame:
    """``(key, stage, answer, failed)`` for every row and stage; NULL answer
    when the prompt is NULL or the call failed, and then ``failed`` is true.

    With a ``cache``, prompts that it knows are not sent, and the answers of
    the others are added to it before anything else uses them.

    With ``max_failure_rate`` the share of failed calls is checked and a
    larger one raises, so that an outage is not stored as defaults.

    Joining answers back: one prompt may be shared by a large share of the
    rows (a hot hash).  Spark broadcasts the de-duplicated answers when their
    bytes allow; beyond that AQE splits the hot partitions of the join."""
    long, uniq = distinct_prompts(df, key, prompts, options)
    if cache is not None:
        answers = cache.answers(uniq, lambda unknown: _answers(unknown, fn, batch_size, partitions))
        _check_failures(answers, max_failure_rate, prompts)
        return _joined(long, key, answers)
    answers = _answers(uniq, fn, batch_size, partitions)
    if checkpoint:
        # Reliable checkpoint in the shared spark.checkpoint.dir: the paid
        # calls run once; downstream retries read the stored answers.
        ensure_checkpoint_dir(df.sparkSession)
        answers = _stored(answers)
        _check_failures(answers, max_failure_rate, prompts)
    return _joined(long, key, answers)


def _answers(uniq: DataFrame, fn, batch_size: int, partitions: int | None) -> DataFrame:
    if partitions:
        uniq = uniq.repartition(partitions, "h")
    return uniq.mapInPandas(_call_batches(fn, batch_size), "h string, answer string, failed boolean")


def _joined(long: DataFrame, key: str, answers: DataFrame) -> DataFrame:
    return long.join(answers, "h", "left").select(key, "stage", "answer", F.coalesce("failed", F.lit(False)).alias("failed"))


def _check_failures(answers: DataFrame, max_failure_rate: float | None, prompts: dict) -> None:
    if max_failure_rate is not None:
        n = answers.agg(F.count(F.lit(1)).alias("calls"), F.count_if("failed").alias("failed")).first()
        if n.calls and n.failed > max_failure_rate * n.calls:
            raise RuntimeError(f"{n.failed} of {n.calls} model calls failed in {sorted(prompts)}")


def infer(df: DataFrame, key: str, prompt: Column, out_col: str, fn, default: str | None = None,
          batch_size: int = 64, partitions: int | None = None) -> DataFrame:
    """Single-column convenience wrapper around :func:`infer_long`."""
    res = infer_long(df, key, {out_col: prompt}, fn, batch_size, partitions).select(
        key, F.col("answer").alias("__answer"))
    out = df.join(res, key, "left")
    ans = F.col("__answer") if default is None else F.coalesce(F.col("__answer"), F.lit(default))
    return out.withColumn(out_col, ans).drop("__answer")
