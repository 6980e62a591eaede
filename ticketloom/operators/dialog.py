"""Conversations: histories, retrieval queries and prompts.

Requests carry their history as an array column, for which the column functions below are meant.
Stored conversations are a long table (conv_id, turn, role, content); there the operators keep one
row per message, so a very long conversation is never gathered into one row or task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom import constants as K
from ticketloom.operators.sampling import top_sources
from ticketloom.operators.skew import skew_join

SYSTEM_PROMPT = (
    "You are an IT support agent. Answer in the language of the question, use the given context when it "
    "is relevant, give numbered basic steps otherwise, and refer to the support desk if they do not help."
)


def valid_messages(history: Column) -> Column:
    """Entries of an array of (role, content) that have both."""
    return F.filter(history, lambda m: m["role"].isNotNull() & m["content"].isNotNull())


def first_user_content(history: Column) -> Column:
    from_user = F.filter(valid_messages(history), lambda m: m["role"] == "user")
    return F.coalesce(F.try_element_at(from_user, F.lit(1))["content"], F.lit(""))


def rag_query(history: Column, query: Column) -> Column:
    """First user message and current query, or the query alone without a history."""
    has_history = F.coalesce(F.size(history) > 0, F.lit(False))
    return F.when(has_history, F.concat(first_user_content(history), F.lit(" "), query)).otherwise(query)


def user_message(queue: Column, urgency: Column, context: Column, question: Column) -> Column:
    category, level, context_label, question_label = K.USER_MESSAGE_LABELS
    return F.concat(
        F.lit(category), queue, F.lit("\n" + level), urgency,
        F.lit("\n" + context_label + "\n"), context, F.lit("\n\n" + question_label + "\n"), question,
    )


def build_messages(history: Column, message: Column, system_prompt: str = SYSTEM_PROMPT) -> Column:
    """System prompt, valid history and the new user message as one array."""

    def entry(role: str, content: Column) -> Column:
        return F.array(F.struct(F.lit(role).alias("role"), content.alias("content")))

    past = F.transform(
        F.coalesce(valid_messages(history), F.array().cast("array<struct<role:string,content:string>>")),
        lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")),
    )
    return F.concat(entry("system", F.lit(system_prompt)), past, entry("user", message))


def valid_message_rows(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("role").isNotNull() & F.col("content").isNotNull())


def last_turns(messages: DataFrame) -> DataFrame:
    """Per conversation its newest message and the first user message before it; partial aggregation only."""
    newest = messages.groupBy("conv_id").agg(
        F.max("turn").alias("last_turn"),
        F.max_by("content", "turn").alias("query"),
        F.min(F.when(F.col("role") == "user", F.struct("turn", "content"))).alias("first_user"),
        F.count("*").alias("n_messages"),
    )
    before = F.when(F.col("first_user.turn") < F.col("last_turn"), F.col("first_user.content"))
    return newest.select(
        "conv_id", "last_turn", "query", F.coalesce(before, F.lit("")).alias("first_user"), "n_messages"
    )


def rag_queries(messages: DataFrame) -> DataFrame:
    """(conv_id, rag_query) treating the newest message as the current query."""
    last = last_turns(valid_message_rows(messages))
    with_history = F.concat(F.col("first_user"), F.lit(" "), F.col("query"))
    return last.select(
        "conv_id", F.when(F.col("n_messages") > 1, with_history).otherwise(F.col("query")).alias("rag_query")
    )


def history_before_last(messages: DataFrame) -> DataFrame:
    """All messages but the newest of each conversation, in long form.

    A message is dropped by comparing its turn with the conversation's last one. The join is salted
    for conversations holding many of the rows, and no window runs over a whole conversation.
    """
    last = messages.groupBy("conv_id").agg(F.max("turn").alias("last_turn"))
    joined = skew_join(messages, last, ["conv_id"], "inner", spread_by=["turn"])
    return joined.where(F.col("turn") < F.col("last_turn")).drop("last_turn")


def message_rows(
    messages: DataFrame, prompts: DataFrame, system_prompt: str = SYSTEM_PROMPT
) -> DataFrame:
    """Prompt of each conversation in long form: (conv_id, position, role, content).

    ``prompts`` holds conv_id and the new user ``message``. Position -1 is the system prompt, history
    keeps its turns, and the new message takes the turn of the one it replaces.
    """
    valid = valid_message_rows(messages)
    last = valid.groupBy("conv_id").agg(F.max("turn").alias("last_turn"))
    system = last.select(
        "conv_id",
        F.lit(-1).cast("bigint").alias("position"),
        F.lit("system").alias("role"),
        F.lit(system_prompt).alias("content"),
    )
    past = history_before_last(valid).select("conv_id", F.col("turn").alias("position"), "role", "content")
    asked = last.join(prompts, "conv_id").select(
        "conv_id", F.col("last_turn").alias("position"), F.lit("user").alias("role"), F.col("message").alias("content")
    )
    return system.unionByName(past).unionByName(asked)


def response_row(answered: DataFrame, n_sources: int = 3) -> DataFrame:
    """(prediction_id, query, predicted_queue, predicted_urgency, response, rag_sources)."""
    return answered.select(
        "prediction_id",
        "query",
        "predicted_queue",
        "predicted_urgency",
        "response",
        top_sources(F.coalesce("sources", F.array().cast("array<string>")), n_sources).alias("rag_sources"),
    )
