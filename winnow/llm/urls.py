"""URL filters: explicit rules, and logistic regression on hashed character n-grams.

A URL's host and path are cut out by expressions.  A rule of a host and a path
prefix fits that host and its subdomains; the longest fitting rule decides.
Where none fits, a logistic regression decides whose features are the
character n-grams of host and path, hashed into BUCKETS weights.  It is trained
on the driver on a labelled table of at most TABLE_ROWS URLs: those in UNWANTED
and NEUTRAL, written by hand, and as many again with the words of the lists
crossed by rule.  Its weights, of fixed size, go to the tasks.

Defined results: a null URL, or one without ``://``, has empty host and path,
no rule, and what the method makes of nothing (its bias: allow).  Repeated rows
have equal verdicts; an empty table gives no rows.  Only page_id and url are
read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm import common

BUCKETS = 1 << 14
GRAMS = (3, 4, 5)
SEED = 5
#: The contract's rules as (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
# The labelled table is made from these: words of hosts and paths, unwanted and neutral.
_BAD = "spam farm cheap pills casino bonus viagra poker xxx porn adult escort loan payday replica click win prize lottery torrent crack keygen warez hack bet slots dating hot sexy free-money crypto-giveaway".split()
_GOOD = "news blog docs wiki library science school city garden music sport travel recipe history weather museum theatre health research open data forum kitchen village river mountain book paper art design code".split()
_PATHS = "article page item post about contact archive topic story guide photo list en de fr es index help".split()


#: Written by hand, each a URL without its scheme, of many forms; none is in the tests.
UNWANTED = """
royal-casino-online.com/slots/free-spins megaslots247.net/play casinobonus.top/no-deposit luckyspin-casino.bet/signup freebets-today.com/odds bet-win-big.info/football sportsbet-tips.club/tips
bet777.vip/register online-betting-offers.biz/bonus bigbet-online.com/live pokerroom-bonus.com/texas-holdem play-poker-online.net/tournament poker-chips-cheap.com/ videopoker-free.info/jacks fullpoker.bet/lobby
blackjack-real-money.com/ roulette-system-win.net/buy jackpot-lottery-winner.info/claim you-won-a-prize.xyz/claim?id=8 free-iphone-giveaway.win/step1 prize-survey-reward.club/start lotto-numbers-win.biz/
cheap-pills-online.com/viagra buy-viagra-now.net/order cialis-generic-discount.biz/ pharmacy-no-prescription.com/tramadol discount-meds-store.ru/cart canadian-pharmacy-24h.info/ rx-pills-cheap.top/buy online-pharmacy-sale.com/xanax
weight-loss-miracle.xyz/order keto-diet-pills.shop/trial testosterone-boost.biz/buy hair-loss-cure.info/buy-now cheap-replica-watches.ru/rolex replica-handbags-outlet.cn/gucci best-replicas-sale.com/watches fake-designer-bags.top/buy
cheap-nike-outlet.ru/shoes outlet-sale-cheap.biz/jordan buy-cheap-followers.com/instagram cheap-essays-writing.com/order buy-essay-now.net/ cheap-flights-deal-win.info/click payday-loan-fast.com/apply instant-cash-loans.net/bad-credit
quick-loans-approved.biz/ loan-no-credit-check.info/apply cash-advance-today.com/ debt-relief-now.biz/free forex-profit-robot.com/join crypto-doubler.io/invest bitcoin-profit-system.top/signup free-bitcoin-generator.xyz/ earn-money-fast.club/home
work-from-home-income.biz/ make-money-online-now.info/secret get-rich-quick.top/ binary-options-win.com/trade hot-singles-near-you.com/chat adult-dating-hookup.net/join sexy-cams-live.com/room free-xxx-videos.net/watch hardcore-porn-tube.com/video
nude-webcam-girls.tv/ escort-girls-city.com/vip milf-dating-sex.net/ teen-cam-chat.xxx/live pornpics-free.org/gallery sexchat-online.info/ adult-toys-discount.biz/sale mail-order-brides.info/russian
cracked-software-download.net/photoshop-keygen serial-keys-free.info/windows warez-torrent-hub.to/download full-version-crack.com/setup.exe keygen-patch.net/ torrent-movies-free.to/hd watch-free-movies-online.xyz/stream free-mp3-download.biz/
game-hacks-cheats.net/unlimited-coins robux-generator-free.xyz/ v-bucks-hack.club/ account-verify-login.xyz/paypal secure-update-bank.top/login apple-id-locked.info/verify microsoft-alert-call.xyz/support win-defender-virus-warning.top/scan
seo-backlinks-cheap.com/buy buy-traffic-now.net/ link-farm-directory.biz/submit article-spinner-free.info/ spam-mailer.top/bulk bulk-email-lists.biz/buy click-here-now.xyz/offer best-deal-buy.ru/cheap-phones hotdeals-buy.biz/cheap-perfume
clickbank-offers.top/weightloss psychic-reading-free.info/ enlarge-pills.biz/ moneyback-slot.win/ 1xslots-mirror.ru/bonus-code vulkan-kazino.ru/igrat kazino-onlain.top/ stavki-na-sport.bet/
""".split()
NEUTRAL = """
www.gardenersdiary.co.uk/roses/pruning.html news.rivertown-gazette.com/2019/05/council-vote blog.smallkitchen.net/recipes/lentil-soup docs.pylibrary.org/en/stable/api.html en.encyclopedia-open.org/wiki/Photosynthesis
www.cityofmillbrook.gov/permits library.northfield.edu/catalog/search school.st-marys.ie/timetable museum-of-transport.org/exhibits/trams www.mountainhut.ch/de/anreise historicalsociety.org/archive/1872 weather.coastguard.gov/marine/forecast
journals.openscience.org/article/10.1234/abc data.health-ministry.gov/hospital-beds research.uni-lakeside.de/projekte/wald forum.bicyclerepair.org/t/gear-cable-routing/231 www.chesscorner.com/openings/sicilian-defence photo.lenscraft.net/gallery/iceland
theatre-royal.co.uk/whats-on choir.stjohns.org/concerts www.birdsofeurope.eu/species/robin stackhelp.com/questions/4521/sort-a-list code.opentools.dev/repo/issues/17 maps.trailfinder.org/route/ridge-walk www.villagebakery.fr/nos-pains
recipes.grandmother.it/pasta/ragu travel.slowtrain.eu/vienna-to-prague www.bookshelf-reviews.com/fiction/2021 podcast.historyhour.org/episodes/rome art.cityscapes.es/exposicion/goya design.typefoundry.net/specimens music.localband.ca/tour-dates
sport.village-fc.org/fixtures www.sailingclub.nz/regatta-results farm-museum.se/om-oss energy.gridwatch.org/today climate.icecores.edu/data/vostok astronomy.skycharts.net/july math.problemweek.edu/week-12 physics.lecturenotes.org/optics.pdf
chemistry.safety-sheets.com/acetone biology.fieldguide.org/mosses geology.rockhounds.us/quartz medicine.journalclub.org/asthma-review law.casenotes.edu/contract parliament.gov/bills/2020/14 court.records.gov/opinions election.results.gov/county
www.sandwell-hospital.nhs.uk/visiting pharmacy.university.edu/courses casino-theatre-history.org/building poker-faced-owl.blog/about winchester-cathedral.org.uk/visit wine-growers.fr/vendanges betterworldbooks.org/donate alphabet-learning.com/letters
essex-county.gov/parks middlesex-library.org/hours sussex-wildlife.org.uk/reserves scunthorpe-museum.org/collections analytics.webstats.dev/docs cocktail-history.com/gin titanic-archive.org/passengers assessment.schools.edu/grade-5
spam-filter.mailserver.org/docs/bayes antispam-research.edu/papers security.patchnotes.org/advisory/12 phishing-awareness.gov/report loans.library.edu/interlibrary debt-statistics.gov/quarterly money-museum.org/coins credit-union.coop/branches
cheap-eats-guide.blog/lisbon bargain-hunt.bbc-fan.org/episodes watchmakers-guild.org/training replica-ship-project.org/build torrent-river-hydrology.edu/gauge crack-propagation.materials.edu/fatigue hacker-news-digest.com/today keyboard-club.com/layouts
diet-research.org/mediterranean pill-bug-facts.org/habitat vitamin-d-study.edu/results lottery-funded-heritage.org.uk/projects prize-lectures.org/chemistry free-software-foundation.example.org/licences click-beetles.org/species dating-methods.archaeology.edu/radiocarbon
adult-education.city.gov/evening-classes escort-vessels.navalhistory.org/class hot-springs-geology.org/iceland sexual-health.clinic.org/advice bonus-army-1932.history.org/march slots-and-tenons.woodwork.com/joints tips.gardening.org/compost support.opensource.dev/faq
""".split()
TABLE_ROWS = 1200


def by_hand() -> list[tuple[str, str, int]]:
    """The table written by hand as (host, path, 1 if unwanted)."""
    cut = lambda u: (u.partition("/")[0], "/" + u.partition("/")[2].partition("?")[0])
    return [(*cut(u), k) for k, us in ((1, UNWANTED), (0, NEUTRAL)) for u in us]


def labelled(n: int = 900, seed: int = SEED) -> list[tuple[str, str, int]]:
    """(host, path, 1 if unwanted), made by rule from the word lists."""
    r = random.Random(seed)
    noise = lambda: "".join(r.choices("thehinerandreatonle", k=r.randint(4, 9)))
    out = []
    for k in range(n):
        bad = k % 3 == 0
        if bad:
            host = r.choice(["-", "", "."]).join(r.sample(_BAD, 2)) if r.random() < 0.7 else f"{r.choice(_BAD)}{r.choice(['-', ''])}{noise()}"
        else:
            host = r.choice([r.choice(_GOOD) + noise(), noise(), f"{r.choice(_GOOD)}-{r.choice(_GOOD)}", noise() + r.choice(_GOOD)])
        host = f"{r.choice(['', 'www.', 'm.', 'blog.'])}{host}.{r.choice(['example.com', 'example.org', 'example.net', 'com', 'org', 'net'])}"
        path = f"/{r.choice(_PATHS)}/{r.choice([str(r.randint(1, 999)), noise(), r.choice(_BAD) if bad and r.random() < 0.4 else r.choice(_GOOD)])}{r.choice(['', '/', '.html'])}"
        out.append((host, path, int(bad)))
    return out


def hashed(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, and the borders of the rows; host and path have buckets of their own."""
    data = [f"\x02{h}\x03".encode() + b"\x04" + f"{p}\x05".encode() for h, p in zip(hosts, paths, strict=True)]
    raw = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64)
    size = np.array([len(x) for x in data])
    row = np.repeat(np.arange(len(data)), size)
    in_path = np.zeros(len(raw), np.uint64)
    mark = np.cumsum(raw == 4)
    start = np.repeat(np.concatenate([[0], np.cumsum(size)[:-1]]).astype(int), size)
    in_path[:] = mark - np.where(start > 0, mark[np.maximum(start - 1, 0)], 0)
    buckets, rows = [], []
    with np.errstate(over="ignore"):
        for n in GRAMS:
            if len(raw) < n:
                continue
            h = in_path[: len(raw) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
            for k in range(n):
                h = (h ^ raw[k : len(raw) - n + 1 + k]) * np.uint64(0x100000001B3)
            ok = row[: len(raw) - n + 1] == row[n - 1 :]
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            buckets.append((h[ok] >> np.uint64(64 - 14)).astype(np.int64))
            rows.append(row[: len(raw) - n + 1][ok])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(len(data) + 1, np.int64)
    rows_, b = np.concatenate(rows), np.concatenate(buckets)
    order = np.argsort(rows_, kind="stable")
    return b[order], np.searchsorted(rows_[order], np.arange(len(data) + 1))


class Weights:
    """w and bias; a URL's score is the mean weight of its n-grams, scaled, and the bias."""

    def __init__(self, rows: list[tuple[str, str, int]], rounds: int = 300, rate: float = 6.0, decay: float = 1e-5) -> None:
        b, border = hashed([r[0] for r in rows], [r[1] for r in rows])
        y = np.array([r[2] for r in rows], float)
        who = np.repeat(np.arange(len(rows)), np.diff(border))
        x = 1 / np.sqrt(np.maximum(np.diff(border), 1))
        self.w, self.bias = np.zeros(BUCKETS), 0.0
        for _ in range(rounds):
            e = 1 / (1 + np.exp(-(np.bincount(who, self.w[b], len(rows)) * x + self.bias))) - y
            self.w -= rate * (np.bincount(b, (e * x)[who], BUCKETS) / len(rows) * 10 + decay * self.w)
            self.bias -= 0.5 * float(e.mean())
        self.bias = min(self.bias, -0.1)

    def score(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        b, border = hashed(hosts, paths)
        total = np.concatenate([[0.0], np.cumsum(self.w[b])])
        n = np.diff(border)
        full = np.array([bool(h or p) for h, p in zip(hosts, paths, strict=True)])
        return np.where(full, (total[border[1:]] - total[border[:-1]]) / np.sqrt(np.maximum(n, 1)), 0.0) + self.bias


@lru_cache(1)
def weights() -> Weights:
    return Weights(by_hand() * 3 + labelled(TABLE_ROWS - 3 * len(by_hand())))


def host_of(url: Column) -> Column:
    """After the first :// up to a slash, question mark, hash or the end; A-Z in lower case."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    out = None
    for h, p, verdict in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def judge(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every URL."""
    url = F.col("url").cast("string")
    pages = common.pick(pages, "page_id", "url")
    d = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    d = d.withColumn("_r", rule_of(F.col("host"), F.col("path")))
    sent = pages.sparkSession.sparkContext.broadcast(weights())  # BUCKETS numbers

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf.reset_index(drop=True)
            pdf["score"] = sent.value.score(pdf["host"].tolist(), pdf["path"].tolist())
            yield pdf

    kind = pages.schema["page_id"].dataType.simpleString()
    flat = d.select("page_id", "host", "path", F.col("_r.rule").alias("rule"), F.col("_r.verdict").alias("ruled"))
    out = flat.mapInPandas(scored, f"page_id {kind}, host string, path string, rule string, ruled string, score double")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score")
