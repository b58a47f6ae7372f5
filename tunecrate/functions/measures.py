"""Measures on play logs: durations, ratings, buckets, source-path modules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clamp(x: Column, upper: float) -> Column:
    return F.least(x, F.lit(upper))


def song_rating(dur: Column, idf: Column) -> Column:
    """Implicit rating of a play: ``log10(dur/0.01 + 1) * idf``."""
    return F.log10(dur / F.lit(0.01) + F.lit(1.0)) * idf


def epoch_micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970 as bigint. Zone-less timestamps are read as UTC in any session zone."""
    if df.schema[ts].dataType.typeName() == "timestamp_ntz":
        since = f"CAST(`{ts}` - TIMESTAMP_NTZ'1970-01-01 00:00:00' AS INTERVAL SECOND)"
        return F.expr(f"CAST(CAST({since} AS DECIMAL(20,6)) * 1000000 AS BIGINT)")
    return F.unix_micros(ts)


def epoch_seconds(df: DataFrame, ts: str) -> Column:
    return epoch_micros(df, ts) / 1e6


def moment(df: DataFrame, ts: str, text: str) -> Column:
    """A literal of the column's own timestamp type, so that comparisons reach the scan."""
    return F.lit(text).cast(df.schema[ts].dataType)


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def effective_seconds(
    version: Column, short_ms: Column, long_ms: Column, length_ms: Column, switch: int = 7900, cap: int = 50
) -> Column:
    """Listening seconds: old clients report ``short_ms``, new ones ``long_ms``.

    Reports over ``cap`` times the song length fall back to one song length.
    """
    reported = (
        F.when((version < switch) & (short_ms >= 0), short_ms)
        .when((version >= switch) & (long_ms >= 0), long_ms)
        .otherwise(F.lit(0))
    )
    return F.when(reported > length_ms * cap, length_ms / 1000).otherwise(reported / 1000)


def range_label(x: Column, ranges: Sequence[tuple[float | None, float | None, str]], other: str) -> Column:
    """First matching closed range ``(low, high, label)``; an open end is ``None``."""
    out = None
    for low, high, label in ranges:
        test = F.lit(True)
        if low is not None:
            test = test & (x >= low)
        if high is not None:
            test = test & (x <= high)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(other)


def size_label(song_count: Column) -> Column:
    """Playlist size buckets of the reports."""
    return (
        F.when(song_count < 30, "(0,30)")
        .when(song_count.between(30, 50), "[30,50]")
        .when(song_count.between(51, 100), "[51,100]")
        .otherwise(">100")
    )


# Module labels of a client source path, tested in this order.
MODULE_RULES: list[tuple[str, str]] = [
    ("推荐内容", "个人模块推荐"),
    ("搜索/(.*/)?(下拉框|历史搜索|手动输入|纠错搜索|标签搜索|其他搜索)$", "搜索-主动"),
    ("搜索/|^搜索$", "搜索-其他"),
    ("^/播放页/关联推荐/相似歌曲$", "播放页-相似歌曲"),
    ("/播放页/", "播放页"),
    ("乐库/", "乐库"),
    ("^/歌单", "歌单"),
    ("/今日歌单|/每日歌曲推荐|^/个性化推荐", "每日推荐"),
    ("/(猜你喜欢|猜你喜欢电台|私人fm)$|^(/私人FM|首页/私人FM|收藏/私人FM)", "猜你喜欢"),
    ("^/?酷群|^/电台/酷群/|^(主页/|/)?(音乐)?电台", "电台.酷群"),
    ("^/?音乐圈|/首页/MV歌单%|^/首页/唱片店", "更多"),
    ("^/?首页/个性化推荐/新歌$", "首页推荐-新歌"),
    ("/首页/个性化推荐/歌单", "首页推荐-歌单"),
    ("听歌识曲", "听歌识曲"),
    ("^/歌手分类", "歌手分类"),
    ("^/个人中心", "个人中心"),
]
DEFAULT_MODULE = "本地模块"


def path_module(path: Column) -> Column:
    """Module of a source path; the first matching rule wins."""
    out = None
    for pattern, label in MODULE_RULES:
        hit = path.rlike(pattern)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(DEFAULT_MODULE)
