"""Schemas and fixed column lists of the periodic video ranking data."""

from __future__ import annotations

from pyspark.sql import types as T

# Interaction counts, in report order, and their display names.
METRICS = ["view", "danmaku", "reply", "favorite", "coin", "share", "like"]
METRIC_NAMES = {
    "view": "播放量",
    "danmaku": "弹幕数",
    "reply": "评论数",
    "favorite": "收藏数",
    "coin": "投币数",
    "share": "分享数",
    "like": "点赞数",
}
BEST_RANK = "his_rank"
DISLIKE = "dislike"
TEXT_FIELDS = ["title", "desc", "rcmd_reason"]

_TEXT = T.StringType()
_STAT_FIELDS = [*METRICS, BEST_RANK, DISLIKE]

# Numbers are read as text, so that a bad value reaches the coercion step instead of spoiling the
# whole document. Only used paths are named: the JSON reader skips the rest.
ITEM = T.StructType(
    [
        T.StructField("title", _TEXT),
        T.StructField("tname", _TEXT),
        T.StructField("desc", _TEXT),
        T.StructField("rcmd_reason", _TEXT),
        T.StructField("owner", T.StructType([T.StructField("name", _TEXT)])),
        T.StructField("stat", T.StructType([T.StructField(name, _TEXT) for name in _STAT_FIELDS])),
    ]
)
ENVELOPE = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField("config", T.StructType([T.StructField("name", _TEXT), T.StructField("etime", _TEXT)])),
                    T.StructField("list", T.ArrayType(ITEM)),
                ]
            ),
        )
    ]
)

# The one definition of the cleaned record; writers and readers both use it.
CLEAN = T.StructType(
    [T.StructField(name, _TEXT) for name in ("period", "up", "title", "tname")]
    + [T.StructField(name, T.LongType()) for name in (*METRICS, BEST_RANK)]
    + [T.StructField(name, _TEXT) for name in ("desc", "rcmd_reason")]
)

WORD_COUNT = T.StructType([T.StructField("word", _TEXT), T.StructField("count", T.LongType())])
LEADERBOARD = T.StructType(
    [
        T.StructField("model", _TEXT),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("auc", T.DoubleType()),
    ]
)
