"""Windows of an account's dealings in a total order, and aggregates that want a full window."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

ACCOUNT, TIME, TIE = "Account_HASHED", "Timestamp", "txn_id"
DAY_US = 86_400_000_000


@dataclass(frozen=True)
class WindowProfile:
    """Row counts of the windows. Small ones fit test data, whose accounts have fewer than 100 rows."""

    n5: int = 5
    n24: int = 24
    n50: int = 50
    n100: int = 100
    n120: int = 120
    n168: int = 168
    n200: int = 200
    n500: int = 500


REFERENCE = WindowProfile()
SMALL = WindowProfile(n5=3, n24=6, n50=10, n100=12, n120=8, n168=9, n200=11, n500=20)


def ordered(*keys: str) -> WindowSpec:
    """By keys (the account unless given), in order of time and txn_id: every window of an account shares one exchange and one sort."""
    return Window.partitionBy(*(keys or (ACCOUNT,))).orderBy(TIME, TIE)


def whole(*keys: str) -> WindowSpec:
    return Window.partitionBy(*(keys or (ACCOUNT,)))


def upto(n: int, *keys: str) -> WindowSpec:
    """The last n rows with this one."""
    return ordered(*keys).rowsBetween(-(n - 1), 0)


def before(n: int, *keys: str) -> WindowSpec:
    """The n rows before this one."""
    return ordered(*keys).rowsBetween(-n, -1)


def full(n: int, made: Column, of: Column, frame: WindowSpec) -> Column:
    """made over the frame where it holds n values of `of`, else null."""
    return F.when(F.count(of).over(frame) >= n, made.over(frame))


def lag1(column: Column | str, *keys: str) -> Column:
    return F.lag(column).over(ordered(*keys))


def micros(column: str = TIME) -> Column:
    return F.unix_micros(F.col(column))


def within(days: int) -> WindowSpec:
    """Rows of the account in (t - days, t]: the far end is open. Ties in time are all within."""
    return Window.partitionBy(ACCOUNT).orderBy(micros()).rangeBetween(-days * DAY_US + 1, 0)


def changed(column: str) -> Column:
    """Whether the column differs from the account's row before, false for its first row and where either is null."""
    return F.coalesce(F.col(column) != lag1(column), F.lit(False))
