"""Allow and block rules for urls, and a logistic regression for those that no rule fits.

The model sees hashed character n-grams of host and path (apart from each other) and is trained
from a small labelled table of urls; its weights have a fixed number of buckets, so they are the
only thing broadcast. A url is judged in its own task; nothing is shuffled.

Defined results: host is what stands after the first '://' up to '/', '?', '#' or the end, A-Z
lower-cased; path goes on up to '?', '#' or the end; a null url, or one without '://', has both
empty and goes to the model, which sees no n-grams and so answers by its intercept; repeated rows have
equal results, columns of any name come back in `row`, and an empty table gives an empty one.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

BUCKETS = 1 << 14

# The rules of the contract.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))

# The small labelled table: made for this module, no url of it is given anywhere.
WANTED = """news.example/world/article-12 museum.example/collection/painting library.example/catalog/history
school.example/course/algebra garden.example/blog/planting-roses weather.example/en/forecast city.example/council/minutes
recipes.example/soup/lentil travel.example/guide/mountains science.example/journal/physics/4411 music.example/lessons/violin
forum.example/thread/9921 wiki.example/page/river docs.example/api/reference theatre.example/fr/programme
bakery.example/es/contacto bridge.example/en/4033 hospital.example/patients/advice nature.example/birds/heron
history.example/en/7817.html letters.example/de/archiv/3 novel.example/chapter/12 stone.example/en/120
northern.example/en/5000 rivers.example/es/8924 winter.example/net/fr/6094 harbor.example/about thread.example/en/9823
blog.tension.example/en/8401 m.thesis.example/es/210 www.then.example/en/77 thing.example/en/4162 other.example/es/311
adulteration.example/en/food farm.example/en/apples www.motion.example/en/6094?page=2 there.example/es/700 blog.nation.example/en/15""".split()
UNWANTED = """casino-royal.example/play win-big.example/jackpot cheap-meds.example/pills/order freebets.example/bonus
online-casino.example/slots poker-win.example/en/44 pills-shop.example/cheap/viagra ads-server.example/click?id=3
track-click.example/ads/banner free-bets-now.example/odds betting-tips.example/win/cash cheap-pills-online.example/en/12
adtracker.example/pixel lucky-slots.example/casino/vip loan-fast.example/cash/free hot-singles.example/xxx
replica-watches.example/cheap win-prizes.example/claim/free casino.example/de/1 tracking-ads.example/redirect
pharmacy-cheap.example/pills/discount bet-bonus.example/free/spins www.roulette-gold.example/en/310 free-cash.example/win
blog.budget-tablets.example/en/66 m.banner-pixel.example/en/98 www.wager-bonus.example/fr/54 adult-cams.example/live
spam-offers.example/deal/cheap crypto-win.example/double/free slots-free.example/en/7 track.example/ads
spam-links.example/en/5 link-farm-spam.example/fr/2 adult-x-video.example/en/6 adult-chat.example/xxx m.bets-casino.example/es/3 www.pills-free.example/en/8 blog.track-ads.example/en/91 casino-bets.example/es/40""".split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label): 1 is unwanted."""
    return spark.createDataFrame([(f"http://{u}", 0) for u in WANTED] + [(f"http://{u}", 1) for u in UNWANTED], "url string, label int")


def split_url(url: str | None) -> tuple[str, str]:
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return lower, re.match(r"[^?#]*", rest[len(host):])[0]


def rule_for(host: str, path: str, rules) -> tuple[str, str] | None:
    """The longest rule whose host is this one or a parent domain, and whose path begins this one."""
    best = None
    for rule, verdict in rules:
        name, slash, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + start) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return best


def places(host: str, path: str, sizes=(2, 3, 4), buckets: int = BUCKETS) -> np.ndarray:
    """The buckets of the distinct n-grams; digits are alike."""
    out = set()
    for kind, s in (("h", f"^{host}$" if host else ""), ("p", re.sub(r"\d+", "0", path))):
        for n in sizes:
            out.update(zlib.crc32(f"{kind}{s[i:i + n]}".encode()) % buckets for i in range(len(s) - n + 1))
    return np.fromiter(sorted(out), np.int64, len(out))


def train(labelled: DataFrame, steps: int = 2000, l2: float = 1e-4, buckets: int = BUCKETS, max_rows: int = 10_000) -> tuple[np.ndarray, float]:
    """Weights and intercept by full-batch gradient descent, on at most `max_rows` labelled urls (smallest
    hashes first, so the choice does not depend on their order)."""
    rows = labelled.where("label is not null").orderBy(F.xxhash64("url"), "label").limit(max_rows).select("url", "label").collect()
    if not rows:
        return np.zeros(buckets), 0.0
    xs = [places(*split_url(r.url), buckets=buckets) for r in rows]
    y = np.array([float(r.label) for r in rows])
    flat, row = np.concatenate(xs), np.repeat(np.arange(len(xs)), [len(x) for x in xs])
    scale = np.array([1 / np.sqrt(max(1, len(x))) for x in xs])
    w, b = np.zeros(buckets), 0.0
    for _ in range(steps):
        z = np.bincount(row, w[flat], len(xs)) * scale + b
        g = (1 / (1 + np.exp(-z)) - y) / len(xs)
        w -= 20 * (np.bincount(flat, (g * scale)[row], buckets) + l2 * w)
        b -= 2 * g.sum()
    return w, float(b)


def url_filter(pages: DataFrame, labelled: DataFrame, rules=RULES, url: str = "url", threshold: float = 0.5) -> DataFrame:
    """`row` (a struct of all input columns), host, path, rule, score (higher: unwanted) and verdict."""
    model = pages.sparkSession.sparkContext.broadcast(train(labelled))

    def run(batches):
        w, b = model.value
        for batch in batches:
            host, path, rule, score, verdict = [], [], [], [], []
            for u in batch.column(1).to_pylist():
                h, p = split_url(u)
                x = places(h, p, buckets=len(w))
                s = float(1 / (1 + np.exp(-(w[x].sum() / np.sqrt(max(1, len(x))) + b))))
                got = rule_for(h, p, rules)
                host.append(h)
                path.append(p)
                score.append(s)
                rule.append(got and got[0])
                verdict.append(got[1] if got else "block" if s >= threshold else "allow")
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.string()) for x in (host, path, rule)), pa.array(score, pa.float64()),
                                              pa.array(verdict, pa.string())], names=["row", "host", "path", "rule", "score", "verdict"])

    rows = pages.select(F.struct("*").alias("row"), F.col(url).alias("url"))
    kinds = [StructField(c, StringType()) for c in ("host", "path", "rule")] + [StructField("score", DoubleType()), StructField("verdict", StringType())]
    return rows.mapInArrow(run, StructType([StructField("row", rows.schema["row"].dataType), *kinds]))
