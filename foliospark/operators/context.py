"""Context of a prompt: safety, redaction, ranking, compression, token budgets, sessions and memory, assembly."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliospark.functions import text as T
from foliospark.functions.scale import cut

#: Instructions hidden in retrieved text, by kind, in English and Vietnamese.
INJECTION = {
    "override": r"(?i)\b(ignore|disregard|forget|override|bypass|do not follow)\b.{0,40}\b(previous|prior|above|all|earlier|your|preceding)\b.{0,40}\b(instruction|prompt|rule|direction|guideline|context)s?\b|(bỏ qua|phớt lờ|quên|không tuân theo).{0,40}(hướng dẫn|chỉ dẫn|yêu cầu|quy tắc|chỉ thị)",
    "role": r"(?i)\b(you are now|act as|pretend to be|from now on,? you|behave like|roleplay as|new persona)\b|(bây giờ bạn là|hãy đóng vai|từ giờ bạn)",
    "prompt_leak": r"(?i)\b(reveal|print|show|repeat|output|leak|tell me)\b.{0,40}\b(system prompt|hidden instructions|initial instructions|your instructions|developer message)\b|(tiết lộ|in ra|hiển thị).{0,30}(prompt hệ thống|chỉ dẫn ẩn|lời nhắc hệ thống)",
    "markup": r"(?i)<\s*/?\s*(system|assistant|instructions?|prompt|user)\s*>|\[\s*/?\s*(INST|SYSTEM|SYS)\s*\]|<\|[a-z_]{2,20}\|>|^\s*#{2,}\s*(system|instruction)s?\s*:",
    "tool": r"(?i)\b(call|execute|run|invoke|trigger)\b.{0,20}\b(the )?(tool|function|command|shell|api|script)\b|(gọi|chạy|thực thi).{0,15}(công cụ|hàm|lệnh)",
    "exfiltration": r"(?i)\b(send|post|upload|forward|email|transmit)\b.{0,40}\b(conversation|password|credential|secret|token|api key|history|personal data)s?\b.{0,40}\b(to|at)\b|!\[[^\]]{0,80}\]\(https?://[^)\s]{1,200}[?&][^)\s]{0,40}=",
    "secrecy": r"(?i)\b(do not|don't|never) (tell|inform|mention|reveal).{0,30}\b(user|anyone|human)s?\b|(không|đừng) (nói|báo|tiết lộ).{0,20}(người dùng|ai biết)",
    "concealment": r"[\x{200b}\x{200c}\x{2060}\x{feff}]{3,}|[\x{e0020}-\x{e007f}]{3,}|[\x{202a}-\x{202e}]",
    "encoded": r"(?i)\b(decode|base64|rot13|hex)\b.{0,40}\b(and|then)\b.{0,20}\b(follow|execute|run|obey)\b",
}
#: Personal data and its replacements, in this order.
PERSONAL = (
    ("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    ("IP", r"\b(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\b"),
    ("CARD", r"\b(?:[0-9]{4}[ -]){3}[0-9]{4}\b"),
    ("PHONE", r"\+?\b[0-9]{1,3}[ .-][0-9]{2,4}[ .-][0-9]{3,4}(?:[ .-][0-9]{3,4})?\b"),
)
#: Shares of the token budget by kind of context, and the order of a prompt.
BUDGET_SHARES = {"system": 0.10, "tool": 0.10, "memory": 0.15, "knowledge": 0.45, "history": 0.20}
PROMPT_ORDER = ("system", "tool", "knowledge", "memory", "history", "query")


def injection_flags(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows with ``flags``: the names of the patterns that the text has (empty for null)."""
    found = F.filter(
        F.array(*[F.when(F.col(text_col).rlike(p.replace("(?i)", "(?iu)")), name) for name, p in INJECTION.items()]),
        lambda x: x.isNotNull()
    )
    return df.withColumn("flags", found)


def redact(text: Column) -> Column:
    """Text with e-mail and IP addresses, card and phone numbers replaced by their kind."""
    for name, pattern in PERSONAL:
        text = F.regexp_replace(text, pattern, f"[{name}]")
    return text


def safe_candidates(candidates: DataFrame, text_col: str = "content") -> DataFrame:
    """Candidates without hidden instructions, redacted."""
    return injection_flags(candidates, text_col).where(F.size("flags") == 0).drop("flags").withColumn(
        text_col, redact(F.col(text_col))
    )


def union_sources(sources: dict[str, DataFrame | None]) -> DataFrame:
    """Candidates of all sources that answered, with ``source_kind``; a missing source (None) and missing columns are
    tolerated.
    """
    every = None
    for kind, df in sources.items():
        if df is not None:
            part = df.withColumn("source_kind", F.lit(kind))
            every = part if every is None else every.unionByName(part, allowMissingColumns=True)
    if every is None:
        raise ValueError("no source answered")
    return every


def over_fetch(candidates: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` best candidates of each query and source."""
    rank = F.row_number().over(Window.partitionBy("query_id", "source_kind").orderBy(F.desc("score"), "chunk_id"))
    return candidates.withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")


def lexical_overlap(query: Column, content: Column) -> Column:
    """Share of the query's terms that the content has; 0 without any."""
    return _share_of(F.array_distinct(T.terms(query)), content)


def _share_of(q: Column, content: Column) -> Column:
    return F.coalesce(F.try_divide(F.size(F.array_intersect(q, T.terms(content))), F.size(q)), F.lit(0.0))


def rerank(
    candidates: DataFrame, queries: DataFrame, scorer: Callable[[Column, Column], Column] = lexical_overlap,
    recency_weight: float = 0.0, trust_weight: float = 0.0, half_life_days: float = 30.0, now: str | None = None
) -> DataFrame:
    """Candidates with ``rerank_score`` of a scorer (any column expression, a pandas UDF too) plus weighted age and
    trust, ranked in each query.
    """
    if scorer is lexical_overlap:  # the terms of a query are made once, not for each of its candidates
        terms = F.array_distinct(T.terms(F.col("query")))
        c = candidates.join(queries.select("query_id", terms.alias("query")), "query_id")
        score = _share_of(F.col("query"), F.col("content"))
    else:
        c = candidates.join(queries.select("query_id", "query"), "query_id")
        score = scorer(F.col("query"), F.col("content"))
    if trust_weight:
        score = score + trust_weight * F.coalesce("trust", F.lit(0.0))
    if recency_weight:
        days = F.datediff(
            F.lit(now).cast("date"), F.col("updated_at").cast("date")
        ) if now else F.datediff(F.current_date(), F.col("updated_at").cast("date"))
        score = score + recency_weight * F.coalesce(F.pow(F.lit(0.5), days / half_life_days), F.lit(0.0))
    c = c.withColumn("rerank_score", F.round(score, 9))
    ties = [k for k in ("chunk_id", "source_kind") if k in c.columns]
    return c.withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("rerank_score"), *ties))
    ).drop("query")


def compress(ranked: DataFrame, queries: DataFrame, keep_verbatim: float = 0.5, sentences: int = 3) -> DataFrame:
    """Candidates under the score ``keep_verbatim`` cut to the ``sentences`` that share most terms with the query, in
    their order.
    """
    c = ranked.join(queries.select("query_id", F.array_distinct(T.terms(F.col("query"))).alias("_q")), "query_id")
    parts = F.filter(F.split("content", r"(?<=[.!?…])\s+"), lambda s: F.length(s) > 0)
    told = F.transform(parts, lambda s, i: F.struct(i.alias("i"), s.alias("s"), T.terms(s).alias("t")))
    # sentences are compared with the terms that content and query share, which are few
    once = lambda value, f: F.transform(F.array(value), f)[0]
    shared = lambda x: F.array_intersect("_q", F.flatten(F.transform(x, lambda y: y["t"])))

    def best(x: Column, m: Column) -> Column:
        scored = F.transform(
            x,
            lambda y: F.struct((-F.size(F.array_intersect(m, y["t"]))).alias("o"), y["i"].alias("i"), y["s"].alias("s"))
        )
        kept = F.transform(
            F.slice(F.array_sort(scored), 1, sentences), lambda y: F.struct(y["i"].alias("i"), y["s"].alias("s"))
        )
        return F.array_join(F.transform(F.array_sort(kept), lambda y: y["s"]), " ")

    short = once(told, lambda x: once(shared(x), lambda m: best(x, m)))
    return c.withColumn(
        "content", F.when(F.col("rerank_score") >= keep_verbatim, F.col("content")).otherwise(short)
    ).drop("_q")


def within_budget(candidates: DataFrame, total_tokens: int, shares: dict[str, float] | None = None) -> DataFrame:
    """Candidates (query_id, source_kind, chunk_id, score, tokens) that fit the share of their kind, best first; the
    running sum stops at the first that does not fit.  Kinds without a share have none.
    """
    shares = shares or BUDGET_SHARES
    table = F.create_map(*[F.lit(x) for k, v in shares.items() for x in (k, int(total_tokens * v))])
    run = F.sum("tokens").over(
        Window.partitionBy("query_id", "source_kind").orderBy(F.desc("score"), "chunk_id").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
    )
    c = candidates.withColumn("used", run).withColumn("budget", F.try_element_at(table, F.col("source_kind")))
    return c.where(F.col("used") <= F.col("budget"))


def build_prompt(bundle: DataFrame, queries: DataFrame, order: tuple[str, ...] = PROMPT_ORDER) -> DataFrame:
    """query_id, prompt: the parts by kind in ``order`` and by score, an empty line between, the question last.
    Knowledge carries its document and page.
    """
    place = F.create_map(*[F.lit(x) for i, k in enumerate(order) for x in (k, i)])
    cite = F.when(
        (F.col("source_kind") == "knowledge") & F.col("doc_name").isNotNull(),
        F.concat(
            F.lit("["), F.col("doc_name"), F.lit(", p. "), F.coalesce(F.col("page_number").cast("string"), F.lit("?")),
            F.lit("] ")
        )
    ).otherwise("")
    part = F.struct(
        F.try_element_at(place, F.col("source_kind")).alias("k"), (-F.col("score")).alias("s"),
        F.col("chunk_id").alias("c"), F.concat(cite, F.col("content")).alias("t")
    )
    parts = bundle.groupBy("query_id").agg(F.array_sort(F.collect_list(part)).alias("p"))
    q = queries.join(parts, "query_id", "left")
    texts = F.coalesce(F.transform("p", lambda x: x["t"]), F.array().cast("array<string>"))
    return q.select("query_id", F.array_join(F.concat(texts, F.array("query")), "\n\n").alias("prompt"))


def session_window(turns: DataFrame, tokens_budget: int | None = None, most_turns: int | None = None) -> DataFrame:
    """Turns (conv_id, turn, tokens, text) with ``kept``: the latest ones within the budgets; the rest is for the
    rolling summary.
    """
    back = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    ok = F.lit(True)
    if tokens_budget is not None:
        ok = ok & (
            F.sum("tokens").over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow)) <= tokens_budget
        )
    if most_turns is not None:
        ok = ok & (F.row_number().over(back) <= most_turns)
    return turns.withColumn("kept", ok)


def rolling_summary(windowed: DataFrame, sentences: int = 3) -> DataFrame:
    """conv_id, summary of the turns that fell out of the session: their ``sentences`` that say most about them, in
    order.

    A sentence counts by its terms: the sum, over its different terms, of the
    number of fallen turns that have it, over the root of its number of terms, so
    neither long nor odd sentences win; equal ones go to the earlier.  A text
    without terms has no sentence.  Frequencies are counted by conversation and
    term with map-side combine, and a conversation keeps only its best sentences,
    however long it is.
    """
    old = windowed.where(~F.col("kept")).select(
        "conv_id", "turn", F.posexplode(F.split(F.coalesce("text", F.lit("")), r"(?<=[.!?…])\s+")).alias("i", "s")
    )
    told = old.select(
        "conv_id", "turn", "i", "s", F.array_distinct(T.terms(F.col("s"))).alias("t")
    ).where(F.size("t") > 0)
    each = told.select("conv_id", "turn", "i", F.size("t").alias("n"), F.explode("t").alias("term"))
    weight = each.select("conv_id", "turn", "term").distinct().groupBy("conv_id", "term").agg(F.count("*").alias("w"))
    score = each.join(weight, ["conv_id", "term"]).groupBy("conv_id", "turn", "i").agg(
        F.round(F.sum("w") / F.sqrt(F.max("n")), 9).alias("score")
    )
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("score"), "turn", "i"))
    best = score.withColumn("r", rank).where(F.col("r") <= sentences).join(
        told.select("conv_id", "turn", "i", "s"), ["conv_id", "turn", "i"]
    )
    items = F.array_sort(F.collect_list(F.struct("turn", "i", "s")))
    return best.groupBy("conv_id").agg(F.array_join(F.transform(items, lambda x: x["s"]), " ").alias("summary"))


def latest_facts(facts: DataFrame) -> DataFrame:
    """user_id, key, value: the fact with the latest time (then the largest value) of each key."""
    return facts.groupBy("user_id", "key").agg(
        F.max_by("value", F.struct("ts", "value")).alias("value"), F.max("ts").alias("ts")
    )


def write_memory(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The memory after new facts: latest wins, writing twice changes nothing."""
    return latest_facts(
        stored.select("user_id", "key", "value", "ts").unionByName(new.select("user_id", "key", "value", "ts"))
    )


def retrieve(
    sources: dict[str, Callable[[], DataFrame]], on_error: Callable[[str, Exception], None] | None = None,
    timeout: float | None = None
) -> DataFrame:
    """Candidates of all sources, asked side by side; one that fails, or takes longer than ``timeout`` seconds, is
    left out and reported.

    A source's rows are computed here and written to the checkpoint folder, so a
    fault that only shows when they are read is met here too.  A source that is
    late has its jobs cancelled by their tag.
    """
    from concurrent.futures import ThreadPoolExecutor

    answers: dict[str, DataFrame | None] = {}
    spark = SparkSession.getActiveSession()

    def work(kind: str, ask: Callable[[], DataFrame], tag: str) -> DataFrame:
        if spark is not None:
            spark.addTag(tag)
        return cut(ask())

    pool = ThreadPoolExecutor(max(1, len(sources)))
    tags = {kind: f"source-{uuid.uuid4().hex}" for kind in sources}
    running = {kind: pool.submit(work, kind, ask, tags[kind]) for kind, ask in sources.items()}
    began = time.monotonic()
    for kind, future in running.items():
        try:
            answers[kind] = future.result(None if timeout is None else max(0.0, began + timeout - time.monotonic()))
        except Exception as error:  # a source that fails must not stop the others
            answers[kind] = None
            if spark is not None:
                spark.interruptTag(tags[kind])
            if on_error:
                on_error(kind, error)
    pool.shutdown(wait=False, cancel_futures=True)
    return union_sources(answers)


def run_steps(
    step: Callable[[int, object], tuple[object, bool]], state: object = None, most: int = 8
) -> tuple[object, int, bool]:
    """A loop of tool steps with a cap: ``step(number, state)`` gives the new state and whether it is done; returns
    state, steps taken, and whether it was done before the cap.
    """
    for number in range(1, most + 1):
        state, done = step(number, state)
        if done:
            return state, number, True
    return state, most, False


def with_retries(call: Callable[[], object], attempts: int = 3, sleep: Callable[[float], None] | None = None):
    """Result of ``call``, tried again after 2, 4, ... seconds; the last error is raised."""
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except Exception:
            if attempt == attempts:
                raise
            (sleep or time.sleep)(2.0**attempt)
