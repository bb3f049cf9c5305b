"""Rate limits: which requests can never go, and what share of a limit a task has."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _check(*limits: int) -> None:
    if any(limit <= 0 for limit in limits):
        raise ValueError("rate limits must be positive")


def infeasible(requests: DataFrame, tokens_per_minute: int, tokens: str = "tokens") -> DataFrame:
    """Requests that can never be admitted, with the ``reason``: to be dead-lettered."""
    _check(tokens_per_minute)
    reason = F.when(
        F.col(tokens) < 0, F.lit("negative token estimate")
    ).when(
        F.col(tokens) > tokens_per_minute,
        F.lit("token estimate above the limit per minute"),
    )
    return requests.withColumn("reason", reason).where(F.col("reason").isNotNull())


def feasible(requests: DataFrame, tokens_per_minute: int, tokens: str = "tokens") -> DataFrame:
    """Requests that can be admitted at some time."""
    _check(tokens_per_minute)
    return requests.where(F.col(tokens).between(0, tokens_per_minute))


def caller_budget(
    requests_per_minute: int, tokens_per_minute: int, callers: int
) -> tuple[float, float]:
    """(requests, tokens) per minute for each of ``callers`` tasks that call at the same time.

    ``callers`` is the number of tasks the session runs at once, or a bound on it.
    """
    _check(requests_per_minute, tokens_per_minute, callers)
    return requests_per_minute / callers, tokens_per_minute / callers


def budget_usage(
    requests: DataFrame,
    caller: str,
    tokens: str,
    requests_per_minute: int,
    tokens_per_minute: int,
    callers: int,
) -> DataFrame:
    """Per caller: requests, tokens, its shares, and the minutes its work needs at least."""
    rpm, tpm = caller_budget(requests_per_minute, tokens_per_minute, callers)
    used = requests.groupBy(caller).agg(
        F.count(F.lit(1)).alias("requests"), F.sum(tokens).alias("tokens")
    )
    return used.withColumns(
        {
            "rpm_share": F.lit(rpm),
            "tpm_share": F.lit(tpm),
            "minutes": F.greatest(F.col("requests") / F.lit(rpm), F.col("tokens") / F.lit(tpm)),
        }
    )
