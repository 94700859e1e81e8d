"""Point look-ups of request keys in keyed state (IDs S4, S5, J1-J4, F1,
F8, C8, C12-C14).

A request is an argument string; it is split on single spaces (empty tokens
dropped) and every token, duplicates included, yields one result row.

Plan (batch):

1. ``freq``: request tokens per requested key (partial aggregate: a hot key
   costs one row per task before the shuffle).
2. ``answers``: the requested keys joined to the state. Both sides are unique
   per key, so there is no skew; AQE broadcasts a side only when its measured
   shuffle output is small, so a state of billions of keys is scanned without
   a shuffle when the requests are few.
3. Hot keys: with P shuffle partitions, every key that holds more than one
   P-th of all request tokens. Fewer than P keys can, so broadcasting them is
   safe by count, and no key outside is larger than a fair partition. A hot
   key's answer row is copied once per salt and its tokens are spread over
   the salts by a hash of the token row; it gets as many salts as it holds
   P-ths of the tokens. Every other key has one salt.
4. The tokens join the answers on ``(key, salt)``. A key holding a third of
   all tokens is split over a third of the partitions; nothing is dropped or
   capped.

``zero`` and ``null`` are left joins from the tokens, so only the answer side
can be broadcast. ``drop`` is an inner join: AQE builds the side whose measured
size is small, which may be the tokens when the requests are few.

Streams answer each micro-batch with this plan
(``tallyflow.streaming.forms.lookup_stream``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.jsonfields import as_text, null_to_zero
from tallyflow.functions.tokens import exclaim
from tallyflow.operators.wordcount import SPACE, tokens

DROP = "drop"   # J1: misses dropped (FilterNull)
ZERO = "zero"   # J2: misses -> 0 (FunctionNullToZero)
NULL = "null"   # J3: misses kept with a null value; the value is text


def request_tokens(requests: DataFrame, args_col: str = "args",
                   id_cols: tuple[str, ...] = ("request_id",),
                   key_col: str = "key") -> DataFrame:
    """S4 + C2: one row per request token with its position ``pos``."""
    return tokens(requests, args_col, SPACE, keep=id_cols, token_col=key_col,
                  with_position=True)


def lookup(req_tokens: DataFrame, state: DataFrame, key_col: str = "key",
           state_key: str | None = None, value_col: str = "count",
           on_miss: str = DROP, out_col: str | None = None) -> DataFrame:
    """Answer each request token from ``state``.

    ``state`` has one row per ``state_key`` (default ``key_col``). Output:
    the request columns plus ``out_col`` (default ``value_col``): a long for
    ``drop``/``zero``, text (null on a miss) for ``null``.
    """
    state_key = state_key or key_col
    out_col = out_col or value_col
    if on_miss not in (DROP, ZERO, NULL):
        raise ValueError(f"on_miss must be {DROP!r}, {ZERO!r} or {NULL!r}")
    if req_tokens.isStreaming:
        raise ValueError("answer a stream with tallyflow.streaming.forms.lookup_stream")
    st = state.select(F.col(state_key).alias(key_col), F.col(value_col).alias("_val"))
    if on_miss == DROP:
        st = st.where(F.col("_val").isNotNull())                                                    # F1
    joined = _salted_join(req_tokens, st, key_col, "inner" if on_miss == DROP else "left")
    value = {DROP: F.col("_val"), ZERO: null_to_zero("_val"), NULL: as_text("_val")}[on_miss]      # C8, C14
    return joined.select(*req_tokens.columns, value.alias(out_col))


def _salted_join(req_tokens: DataFrame, st: DataFrame, key_col: str, how: str) -> DataFrame:
    req_cols = req_tokens.columns
    parts = int(req_tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    freq = (req_tokens.where(F.col(key_col).isNotNull())
            .groupBy(key_col).agg(F.count(F.lit(1)).alias("_cnt")))
    answers = freq.select(key_col).join(st, key_col, "inner")
    total = freq.select(F.sum("_cnt")).scalar()
    share = F.col("_cnt") * parts / total
    hot = F.broadcast(freq.where(share > 1).select(      # fewer than ``parts`` rows
        key_col, F.ceil(share).cast("int").alias("_salts")))
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    toks = (req_tokens.join(hot, key_col, "left")
            .select(*req_cols, F.pmod(F.xxhash64(*req_cols), salts).cast("int").alias("_salt")))
    ans = (answers.join(hot, key_col, "left")
           .select(key_col, "_val", F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt")))
    return toks.join(ans, [key_col, "_salt"], how)


def lookup_identity(req_tokens: DataFrame, key_col: str = "key",
                    out_col: str = "result") -> DataFrame:
    """J4 + F8: the query function that returns the key tuple itself;
    null keys are skipped."""
    return (req_tokens.where(F.col(key_col).isNotNull())
            .select(*req_tokens.columns, F.array(F.col(key_col)).alias(out_col)))


def exclaim_reply(requests: DataFrame, args_col: str = "args",
                  id_cols: tuple[str, ...] = ("request_id",), times: int = 1,
                  out_col: str = "result") -> DataFrame:
    """Reply ``args + '!' * times``, request id passed through."""
    return requests.select(*id_cols, exclaim(args_col, times).alias(out_col))
