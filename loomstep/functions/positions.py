"""Position ids of sequences with runs of text and grids of vision tokens, along time, height and width."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens before a grid, of an image and of a video.
VISION_START, IMAGE, VIDEO = 151652, 151655, 151656
BLOCK = "struct<start:int,t:int,h:int,w:int,rate:double>"


def blocks(ids: Column, images: Column, videos: Column, merge: int = 2, rates: Column | None = None, split_frames: bool = False, image_rate: float = 0.0, video_rate: float = 1.0) -> Column:
    """The grids of a sequence in order: where each starts, its size after merging, and the steps in time per frame. A grid
    starts where a vision token follows the start token; grids (arrays of t, h, w) are used up in order. With ``split_frames``
    each frame of a video is a grid of its own. ``rates`` has a number for each video."""
    before = F.concat(F.array(F.lit(-1)), F.slice(ids, F.lit(1), F.greatest(F.size(ids) - 1, F.lit(0))))
    starts = F.filter(
        F.transform(F.arrays_zip(ids.alias("x"), before.alias("b")), lambda e, i: F.struct(i.alias("at"), (e["x"] == VIDEO).alias("video"), ((e["b"] == VISION_START) & e["x"].isin(IMAGE, VIDEO)).alias("is"))),
        lambda e: e["is"],
    )
    grid = lambda g: F.struct(g[0].alias("t"), g[1].alias("h"), g[2].alias("w"))
    pictures = F.transform(images, lambda g: F.struct(grid(g).alias("g"), F.lit(image_rate).alias("rate")))
    speed = rates if rates is not None else F.array_repeat(F.lit(video_rate), F.size(videos))
    films = F.zip_with(videos, speed, lambda g, r: F.struct(grid(g).alias("g"), r.cast("double").alias("rate")))
    if split_frames:
        one = F.flatten(F.transform(films, lambda f: F.array_repeat(f, f["g"]["t"])))
        films = F.transform(one, lambda f: F.struct(F.struct(F.lit(1).alias("t"), f["g"]["h"].alias("h"), f["g"]["w"].alias("w")).alias("g"), F.lit(0.0).alias("rate")))
    # Number the starts within their kind, by one pass over the few starts.
    none = F.struct(F.lit(0).alias("i"), F.lit(0).alias("v"), F.array().cast("array<struct<at:int,video:boolean,n:int>>").alias("out"))
    numbered = F.aggregate(
        starts, none,
        lambda a, s: F.struct(
            (a["i"] + F.when(s["video"], 0).otherwise(1)).alias("i"), (a["v"] + F.when(s["video"], 1).otherwise(0)).alias("v"),
            F.concat(a["out"], F.array(F.struct(s["at"].cast("int").alias("at"), s["video"].alias("video"), F.when(s["video"], a["v"]).otherwise(a["i"]).alias("n")))).alias("out"),
        ),
        lambda a: a["out"],
    )
    pick = lambda s: F.when(s["video"], F.get(films, s["n"])).otherwise(F.get(pictures, s["n"]))
    cut = lambda n: F.floor(n / F.lit(merge)).cast("int")
    return F.transform(F.transform(numbered, lambda s: F.struct(s["at"].alias("at"), pick(s).alias("p"))), lambda b: F.struct(b["at"].alias("start"), b["p"]["g"]["t"].cast("int").alias("t"), cut(b["p"]["g"]["h"]).alias("h"), cut(b["p"]["g"]["w"]).alias("w"), b["p"]["rate"].alias("rate")))


def positions(grids: Column, size: Column) -> Column:
    """A struct of three arrays (t, h, w) over a sequence of ``size`` tokens. Text counts on along all three from one above the
    highest place so far; a grid begins there and counts frames (times their rate, rounded down), rows and columns."""
    piece = "struct<text:int,n:int,t:int,h:int,w:int,rate:double>"
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("next"), F.array().cast(f"array<{piece}>").alias("pieces"))

    def add(a: Column, g: Column) -> Column:
        n = g["start"] - a["end"]
        base = a["next"] + n
        far = F.greatest(F.floor((g["t"] - 1) * g["rate"]).cast("int"), g["h"] - 1, g["w"] - 1)
        own = F.struct(a["next"].alias("text"), n.alias("n"), g["t"].alias("t"), g["h"].alias("h"), g["w"].alias("w"), g["rate"].alias("rate"))
        return F.struct((g["start"] + g["t"] * g["h"] * g["w"]).alias("end"), (base + far + 1).alias("next"), F.concat(a["pieces"], F.array(own)).alias("pieces"))

    def tail(a: Column) -> Column:
        rest = F.struct(a["next"].alias("text"), (size - a["end"]).cast("int").alias("n"), F.lit(0).alias("t"), F.lit(0).alias("h"), F.lit(0).alias("w"), F.lit(0.0).alias("rate"))
        return F.concat(a["pieces"], F.array(rest))

    run = lambda start, n: F.when(n > 0, F.sequence(start, start + n - 1)).otherwise(F.array().cast("array<int>"))
    pieces = F.aggregate(grids, zero, add, tail)

    def along(place) -> Column:
        return F.flatten(F.transform(pieces, lambda p: F.concat(run(p["text"], p["n"]), F.transform(run(F.lit(0), p["t"] * p["h"] * p["w"]), lambda i: p["text"] + p["n"] + place(p, i)))))

    whole = lambda x: F.floor(x).cast("int")
    return F.struct(
        along(lambda p, i: whole(whole(i / (p["h"] * p["w"])) * p["rate"])).alias("t"),
        along(lambda p, i: whole(i / p["w"]) % p["h"]).alias("h"),
        along(lambda p, i: i % p["w"]).alias("w"),
    )


def position_ids(ids: Column, images: Column, videos: Column, version: str, merge: int = 2, seconds: Column | None = None) -> Column:
    """The three published numberings: ``frames`` (each frame of a video a grid of its own, no time inside), ``seconds`` (two
    steps of time for each second that a video's frame lasts, images without time) and ``index`` (frames count as they are)."""
    if version == "frames":
        found = blocks(ids, images, videos, merge, split_frames=True)
    elif version == "seconds":
        found = blocks(ids, images, videos, merge, rates=F.transform(seconds, lambda s: s * 2) if seconds is not None else None, video_rate=2.0)
    elif version == "index":
        found = blocks(ids, images, videos, merge, image_rate=1.0)
    else:
        raise ValueError(f"unknown numbering: {version}")
    return positions(found, F.size(ids))
