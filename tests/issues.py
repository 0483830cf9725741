"""Writes small issue files for tests."""

from __future__ import annotations

import json
import random
from pathlib import Path

from rankweave.schemas import METRICS

UPS = ["hot", "hot", "hot", "老张", "anna", "bob", " cleo "]
WORDS = ["中国", "游戏", "best", "UP", "video", "the", "hand", "made"]


def write_issues(folder: Path, count: int = 12, items: int = 25, seed: int = 8) -> int:
    """Files `issue_<n>.json` with duplicates, invalid, incomplete and empty values, and a broken one."""
    rng = random.Random(seed)
    folder.mkdir(parents=True, exist_ok=True)
    written = 0
    for number in range(1, count + 1):
        entries = []
        for _ in range(items):
            rank = rng.randint(0, 20)
            stat = {m: max(0, int(rng.gauss(5000 - 200 * rank, 900))) for m in METRICS}
            stat |= {"his_rank": rank, "dislike": 0 if rng.random() < 0.95 else 1}
            if rng.random() < 0.04:
                stat["coin"] = rng.choice([None, "n/a", 0])
            title = " ".join(rng.choice(WORDS) for _ in range(3)) + f" {rng.randint(0, 90)}"
            entry = {"title": title + rng.choice(["", "\t", " "]), "tname": rng.choice(["搞笑", "music", ""]), "stat": stat}
            entry["owner"] = {"name": rng.choice(UPS), "mid": 1} if rng.random() < 0.97 else None
            entry["desc"] = rng.choice(["", " \n", "a line\nanother", "中国 游戏"])
            entry["rcmd_reason"] = rng.choice(["", "good video", None])
            entries.append(entry)
            written += 1
        document = {"code": 0, "data": {"config": {"name": f"第{number}期"}, "list": entries}}
        (folder / f"issue_{number}.json").write_text(json.dumps(document, ensure_ascii=False), encoding="utf-8")
    (folder / "issue_broken.json").write_text('{"data": {"list": [', encoding="utf-8")
    return written
