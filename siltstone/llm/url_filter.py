"""URL filters: rules first, and for the rest a logistic regression on hashed character n-grams.

Features are the n-grams of three to five bytes of the host and of the path, each
kind hashed apart.  The model is trained from a small table of labelled URLs.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from siltstone.llm.arrow import with_texts

FEATURE_BITS = 18
GRAMS = (3, 4, 5)
BLOCK_FROM = 0.5

#: Rows of the labelled table that are used at most, half of them of either class.
TRAIN_ROWS = 5000

#: The rules of the filter, host and path as written, longest wins.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)

#: URLs labelled by hand, unwanted first.
BLOCKED_URLS = (
    "http://www.casino-royal.test/win/now", "https://m.best-casino.test/play", "http://lucky-casino-bonus.test/en/12",
    "https://online-casino.test/slots.html", "http://m.big-win-casino.test/de/44", "https://jackpot-win.test/offer",
    "https://www.win-prizes.test/claim", "https://www.cheap-meds.test/order", "http://m.pills-online.test/buy",
    "https://discount-pills.test/cart", "http://cheap-viagra.test/en/5", "https://pharma-cheap.test/pills.html",
    "http://diet-pills.test/es/9", "https://www.ads.tracker.test/click?id=4", "http://blog.ad-server.test/banner",
    "https://track-clicks.test/pixel", "http://adtrack.test/redirect", "https://m.ads-network.test/fr/7",
    "https://www.popup-ads.test/x", "https://click-track.test/c", "http://free-ringtones.test/download",
    "https://xxx-video.test/watch", "http://adult-cams.test/live", "https://blog.hot-singles.test/join",
    "http://payday-loans.test/apply", "http://www.cheap-loans.test/now", "http://replica-watches.test/shop",
    "https://cheap-handbags.test/sale", "http://betting-tips.test/odds", "https://poker-bonus.test/join",
    "https://www.sports-bets.test/live", "http://best-bets.test/en/31", "https://m.bets-today.test/odds/2",
    "http://free-spins.test/fr/8", "https://www.free-bet-codes.test/join", "http://horse-bets.test/es/17",
    "https://blog.link-farm.test/12", "http://www.content-farm.test/page/9", "https://click-farm.test/en/70",
    "http://spam-links.test/de/3", "https://www.spam-mailer.test/list", "http://m.seo-spam.test/fr/61",
    "https://comment-spam.test/x.html", "http://like-farm.test/buy", "https://www.adult-video.test/watch",
    "http://adult-chat.test/en/6", "https://m.adult-dating.test/join", "http://xxx-tube.test/es/2",
    "https://www.porn-x.test/clip", "http://sexy-cams.test/live", "https://www.free-warez.test/crack",
    "http://torrent-crack.test/download", "https://keygen-free.test/get", "http://free-movies-stream.test/play",
    "https://login-verify-account.test/signin", "http://secure-bank-update.test/confirm", "https://m.miracle-diet.test/order",
    "http://get-rich-quick.test/now", "https://www.crypto-doubler.test/send", "http://essay-mill.test/buy",
    "http://spam-blast.test/en/44", "https://www.bulk-spam.test/fr/9", "http://spamdexing.test/de/21",
    "https://m.review-farm.test/es/6", "http://troll-farm.test/post", "https://account-farm.test/sale",
    "https://adult-pics.test/en/18", "http://www.adult-movies.test/de/5", "https://free-adult-clips.test/play",
    "http://m.adult-toys.test/shop", "https://adult-webcam.test/fr/33", "http://blog.adult-stories.test/es/14",
    "https://x-videos.test/watch", "http://casino-games.test/fr/19", "https://ads-server.test/en/2",
)
ALLOWED_URLS = (
    "https://en.encyclopedia.test/wiki/history", "https://www.university.test/research/paper.html",
    "http://news.daily.test/world/2020/05", "https://blog.garden.test/en/1204", "https://docs.library.test/api/index.html",
    "http://www.museum.test/fr/collection", "https://m.weather.test/de/today", "https://recipes.kitchen.test/es/soup",
    "http://forum.cyclists.test/thread/88", "https://www.council.test/planning/4410", "https://journal.physics.test/vol/12",
    "http://www.school.test/en/lessons/3", "https://travel.railway.test/timetable", "https://books.archive.test/item/991",
    "http://code.project.test/readme", "https://www.hospital.test/departments", "https://learn.language.test/fr/2",
    "http://blog.thinker.test/2019/essay", "https://photo.nature.test/birds/7.html", "https://www.theatre.test/en/programme",
    "http://history.village.test/church", "https://data.statistics.test/table/5", "https://music.choir.test/de/concert",
    "http://m.reader.test/en/story/100", "https://www.parliament.test/debates/61", "https://chess.club.test/games/2",
    "http://maps.county.test/roads", "https://www.farmers.test/market", "https://radio.station.test/schedule",
    "http://www.letters.test/es/archive",
    "https://www.dairy-farm.test/visit", "http://windfarm.energy.test/en/14", "https://blog.farmhouse.test/de/5",
    "http://alphabet.school.test/letters", "https://m.tibetan.culture.test/fr/3", "http://www.adult-education.test/courses",
    "https://adults.learning.test/en/22", "http://freedom.press.test/reports", "https://www.free-library.test/catalogue",
    "http://m.freeway.traffic.test/es/40", "https://xylophone.orchestra.test/concert", "http://www.x-ray.physics.test/paper",
    "https://winter.sports.test/results", "http://window.repair.test/guide", "https://www.roads.authority.test/de/77",
    "http://readers.choice.test/en/9", "https://railtrack.museum.test/history", "http://track-cycling.test/club",
    "https://pillar.architecture.test/fr/6", "http://www.clickstream.research.test/thesis", "https://bank.notes.test/museum",
    "http://credit-union.test/about", "https://m.cinema.test/en/programme", "http://pharmacy.university.test/study",
    "https://www.diet.hospital.test/advice", "http://essays.philosophy.test/es/8", "https://thornton.village.test/news",
    "http://weather.north.test/today", "https://www.northern.theatre.test/fr/30", "http://station.other.test/page/4.html",
    "https://www.farming.county.test/en/18", "http://spa.gardens.test/visit", "https://spanish.lessons.test/es/2",
    "http://farther.travel.test/fr/12", "https://m.charm.pottery.test/shop", "http://account.library.test/renew",
    "http://stories.archive.test/en/18", "https://games.club.test/de/5", "http://server.project.test/docs/2",
    "https://www.movies.history.test/fr/33", "http://toys.museum.test/es/14", "https://blog.webcam.weather.test/today",
    "http://pics.nature.test/birds", "https://www.clips.radio.test/en/2", "http://shop.bakery.test/fr/19",
)

_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
_SLOTS = 1 << FEATURE_BITS


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def rule_fits(rule: str, host: Column, path: Column) -> Column:
    """Whether the host is the rule's or below it, and the path starts with the rule's."""
    name, _, rest = rule.partition("/")
    return ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))


def by_rules(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, or null, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):
        fits = rule_fits(text, host, path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def split_url(url: str) -> tuple[str, str]:
    """Host and path of one URL, as the column expressions give them."""
    _, found, rest = url.partition("://")
    rest = rest.partition("?")[0].partition("#")[0] if found else ""
    host, slash, path = rest.partition("/")
    return host.translate(str.maketrans(_UPPER, _LOWER)), slash + path


def _slots(part: bytes, kind: int) -> list[np.ndarray]:
    data = np.frombuffer(b"\x02" + part + b"\x03", np.uint8).astype(np.uint64)
    out = []
    for n in GRAMS:
        if len(data) >= n:
            code = np.full(len(data) - n + 1, 131 * n + kind, np.uint64)
            for k in range(n):
                code = code * np.uint64(0x100000001B3) + data[k : len(data) - n + 1 + k]
            code = (code ^ code >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15)
            out.append((code >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))
    return out


def features(host: bytes, path: bytes) -> np.ndarray:
    """Slots of the distinct n-grams of a URL."""
    found = [*_slots(host, 1), *_slots(path, 2)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


@dataclass(frozen=True)
class Model:
    """Weights by slot, and the bias."""

    weights: np.ndarray
    bias: float

    def probability(self, host: bytes, path: bytes) -> float:
        """That the URL is unwanted."""
        slots = features(host, path)
        margin = self.bias + self.weights[slots].sum(dtype=np.float64) / np.sqrt(max(len(slots), 1))
        return float(1 / (1 + np.exp(-margin)))


def bounded(labelled: Sequence[tuple[str, bool]]) -> list[tuple[str, bool]]:
    """At most ``TRAIN_ROWS`` rows in their order: of a class beyond its half, those with the least hash of the URL.

    What one class leaves of its half the other may use.
    """
    rows = list(labelled)
    if len(rows) <= TRAIN_ROWS:
        return rows
    classes = [[i for i, (_, bad) in enumerate(rows) if bool(bad) == kind] for kind in (False, True)]
    kept: list[int] = []
    for own, other in (classes, classes[::-1]):
        most = max(TRAIN_ROWS // 2, TRAIN_ROWS - len(other))
        kept += sorted(own, key=lambda i: (xxhash.xxh64_intdigest(rows[i][0].encode()), i))[:most]
    return [rows[i] for i in sorted(kept)]


def train(labelled: Sequence[tuple[str, bool]], steps: int = 800, penalty: float = 1e-4) -> Model:
    """A model from (url, unwanted) rows, by gradient steps over what ``bounded`` keeps; no row gives even odds."""
    rows = bounded(labelled)
    weights, bias = np.zeros(_SLOTS), 0.0
    if not rows:
        return Model(weights, bias)
    parts = [features(h.encode(), p.encode()) for h, p in (split_url(u) for u, _ in rows)]
    flat, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    used, slot = np.unique(flat, return_inverse=True)
    scale = 1 / np.sqrt(np.maximum([len(p) for p in parts], 1))
    target = np.array([float(bad) for _, bad in rows])
    w = np.zeros(len(used))
    for _ in range(steps):
        margin = bias + np.bincount(owner, w[slot], len(rows)) * scale
        wrong = 1 / (1 + np.exp(-margin)) - target
        w -= 4.0 * (np.bincount(slot, (wrong * scale)[owner], len(used)) / len(rows) + penalty * w)
        bias -= 0.5 * wrong.mean()
    weights[used] = w
    return Model(weights, bias)


def default_model() -> Model:
    return train([*((u, True) for u in BLOCKED_URLS), *((u, False) for u in ALLOWED_URLS)])


def judge(
    pages: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str]] = RULES, model: Model | None = None
) -> DataFrame:
    """Rows (key, host, path, rule, verdict, p_block) for every row of ``pages``.

    A rule's verdict holds where one fits; else the model blocks from
    ``BLOCK_FROM``.  A null URL, or one without ``://``, has empty host and path and is judged on those.
    Repeated rows are judged alike; an empty table gives no rows; other columns are not read.
    """
    model = model or default_model()
    link = pages[f"`{url}`"]
    cut = pages.select(pages[f"`{key}`"].alias(key), host_of(link).alias("host"), path_of(link).alias("path"))
    cut = cut.withColumn("_both", F.concat_ws("/", F.col("host"), F.col("path")))

    def step(batch: list[bytes | None]) -> list[Sequence]:
        # The host holds no slash, so the first one is the joint.
        halves = [(t or b"/").partition(b"/") for t in batch]
        return [[model.probability(host, path) for host, _, path in halves]]

    scored = with_texts(cut, [key, "host", "path"], "_both", [T.StructField("p_block", T.DoubleType())], lambda: step)
    rule, verdict = by_rules(rules, F.col("host"), F.col("path"))
    guess = F.when(F.col("p_block") >= BLOCK_FROM, "block").otherwise("allow")
    return scored.select(key, "host", "path", rule.alias("rule"), F.coalesce(verdict, guess).alias("verdict"), "p_block")
