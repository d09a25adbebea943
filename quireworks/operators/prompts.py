"""From ranked hits to one prompt per question."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hits per answer and the prompt text, line breaks and indents included.
ANSWER_K = 3
PROMPT_TEMPLATE = """
        Based on the following research findings, answer the student's question:

        Research Context:
        {context}

        Researcher's Question: {question}

        Answer: Provide a comprehensive answer based on the findings above.
        """


def context_part(title: Column, content: Column) -> Column:
    return F.concat(F.lit("From "), title, F.lit(":\n"), content)


def assemble_context(hits: DataFrame, k: int = ANSWER_K) -> DataFrame:
    """One context per query: its first ``k`` hits in rank order, a blank line between."""
    hit = F.struct("rank", "title", "content", "distance") if "distance" in hits.columns else None
    parts = hits.filter(F.col("rank") <= k).select(
        "query_id",
        "rank",
        context_part(F.col("title"), F.col("content")).alias("part"),
        *([] if hit is None else [hit.alias("hit")]),
    )
    ordered = F.expr(r"listagg(part, '\n\n') WITHIN GROUP (ORDER BY rank)")
    more = [] if hit is None else [F.array_sort(F.collect_list("hit")).alias("hits")]
    return parts.groupBy("query_id").agg(ordered.alias("context"), *more)


def prompt_text(context: Column, question: Column) -> Column:
    before, rest = PROMPT_TEMPLATE.split("{context}")
    between, after = rest.split("{question}")
    return F.concat(F.lit(before), context, F.lit(between), question, F.lit(after))


def assemble_prompts(hits: DataFrame, questions: DataFrame, k: int = ANSWER_K) -> DataFrame:
    """query_id, question, prompt; a question without any hit gets an empty context.

    Hits with a distance come along as ``hits``, an array of (rank, title, content, distance).
    """
    joined = questions.select("query_id", "question").join(
        assemble_context(hits, k), "query_id", "left"
    )
    context = F.coalesce(F.col("context"), F.lit(""))
    return joined.select(
        "query_id",
        "question",
        prompt_text(context, F.col("question")).alias("prompt"),
        *(["hits"] if "hits" in joined.columns else []),
    )
