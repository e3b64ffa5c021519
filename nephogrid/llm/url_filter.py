"""URL filters: explicit rules first, then logistic regression on hashed character n-grams of host and path.

Everything runs in the JVM: string functions cut host and path, the n-grams are arrays, and MLlib hashes, fits and scores them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nephogrid.llm._common import ascii_lower

BUCKETS = 1 << 15
REGULAR = 0.01
GRAMS = (3, 4, 5)


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    block: bool

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    UrlRule("com", "/en/", True),
    UrlRule("example.com", "/en/7", False),
    UrlRule("net", "/de/", False),
    UrlRule("example.net", "/de/8", True),
    UrlRule("org", "/es/", True),
)

#: Labelled URLs the model learns from: first those to block (advertising, tracking, gambling, adult, fraud, malware, piracy, link farms), then
#: those to allow. Each URL stands between blanks.
BLOCKED = """
http://ads.medianet-one.com/banner/728x90 https://ad-server.clickstorm.net/click?id=7 http://track.pixelhub.io/pixel.gif http://adtracker.roi-link.net/redirect
https://tracking.mailopen.com/beacon/open http://clicks.affiliate-desk.org/affiliate/offer https://popads.trafficjet.com/serve http://cdn.adserve-cloud.net/sponsored/
https://banner-exchange.co/popunder/12 https://go.offerwall.biz/aff_c?offer_id=5 http://doubleads.xyz/impression https://casino-bonus.top/slots/free-spins
http://poker-casino.bet/jackpot https://best-betting.club/odds/bonus http://slotmachine-online.info/no-deposit https://www.roulette-live.win/welcome-bonus
http://sportsbet-tips.net/free-bets https://bingo-jackpots.com/join http://lotto-winner.biz/claim-prize http://xxx-videos.tube/porn/1 https://adult-porn.cam/cams
http://free-xxx.org/sex/gallery https://hot-girls-dating.com/hookup http://milf-sex-chat.net/webcam https://nude-pics.club/erotic/2 http://escort-girls.city/book
http://www.sexshop-xxx.biz/toys https://malware-download.ru/crack/keygen.exe http://warez-zone.to/torrent/cracked https://phish-login.com/verify-account/password
http://secure-paypa1-login.com/signin http://appleid-verify.info/update-billing https://free-antivirus-scan.xyz/setup.exe http://serial-keys.net/activation/crack.zip
https://bank-account-confirm.top/login.php http://cheap-pills.net/viagra/buy-now https://online-pharmacy-rx.biz/cialis http://buy-viagra-cheap.com/order
https://weight-loss-miracle.info/diet-pills http://canadian-meds.shop/no-prescription https://steroids-store.net/buy http://replica-watches.cc/rolex
http://fake-handbags.shop/cheap-louis https://spam-links.net/seo/backlinks http://link-farm.org/directory/add-url https://article-spinner.com/seo-content
http://buy-followers.biz/instagram https://cheap-seo-backlinks.com/pricing http://web-directory-links.info/submit http://guestpost-market.net/buy-links
http://spamblog.top/make-money-fast https://make-money-online.biz/get-rich http://crypto-doubler.io/invest-now https://forex-signals-pro.net/profit
http://binary-options-win.com/bonus https://payday-loans-fast.com/apply http://credit-repair-now.biz/offer https://work-from-home-cash.info/earn
http://free-iphone-winner.club/claim https://survey-rewards.win/gift-card http://prize-giveaway.online/winner https://click-here-now.xyz/offer
https://download-mp3-free.cc/crack http://torrent-movies.to/pirate/1080p https://watch-free-stream.cc/popup http://keygen-cracks.net/serial
https://hacked-accounts.biz/netflix https://ads.yieldpartner.com/serve/vast http://adclick.mediabuyers.net/click?cid=88 https://trk.conversion-link.com/track/open
http://tracker.visitor-stats.net/collect https://static.adsystem-cdn.com/banner.js http://advertising-exchange.com/bid https://adtrack.leadgen-pros.com/pixel
http://megabet-casino.com/register https://bets-online.net/football/odds http://live-betting-odds.org/bonus https://casino-royale-slots.net/spin
http://pokerstake.org/freeroll https://spam-mailer.net/bulk http://spammy-comments.org/post https://bulk-spam-tools.com/buy http://xxxmovies-hd.com/watch
https://adult-toons.net/gallery http://pornstars-clips.org/new https://teen-porn-cams.com/live http://adultfriend-match.net/profiles https://track-my-clicks.com/r/99
http://ads-manager-login.net/verify https://spamtrafficbot.com/hits http://casinobets-vip.org/welcome https://sexcam-adult.net/rooms http://tracking-scripts.org/t.js
https://www.888casino.com/en/promotions/12 https://sports.bwin.com/de/wetten/4 https://www.unibet.fr/fr/paris-sportifs https://www.betway.es/es/apuestas/7
https://www.pokerstars.eu/fr/poker https://www.partycasino.com/en/games/31 https://ad.doubleclick.net/en/pagead/12 https://track.adform.net/de/serving/88
https://adserver.adtech.de/fr/banner/6 https://ads.pubmatic.com/es/adserver https://www.freebets.co.uk/en/offers/2 https://www.adultfriendfinder.com/de/members
https://tracker.marinsm.com/en/rd/120 https://www.casino.org/fr/bonus https://www.xvideos.com/es/videos/9 https://www.livejasmin.com/en/girls
https://www.betfair.com/es/apuestas https://www.paddypower.com/en/bet https://www.williamhill.es/es/casino https://www.leovegas.com/de/casino
https://www.tracktrack.it/en/rd https://www.pornhub.com/fr/video https://www.redtube.com/de/2210 https://www.bet-at-home.com/de/sport https://www.ladbrokes.be/fr/sports
https://adclick.g.doubleclick.net/en/aclk https://www.bannersnack.com/es/banner https://cheapseo.co/en/spam-links https://www.spamzilla.io/en/domains
https://track.hubspot.com/__ptq.gif https://tracking.g2crowd.com/attribution https://ads.linkedin.com/collect/1 https://ads.yahoo.com/pixel
https://ads.stickyadstv.com/auto-user-sync https://ads.betweendigital.com/match
"""
ALLOWED = """
http://news.northshore.net/world/2020/election-report https://www.university-hall.edu/physics/lecture-notes https://docs.buildtool.dev/guide/install.html
http://library.oldtown.org/catalogue/history https://recipes.kitchenbook.net/bread/sourdough http://museum.riverside.com/exhibits/paintings
https://weather.coastline.org/forecast/tomorrow http://forum.woodworkers.net/thread/12774 https://shop.novelhouse.com/books/novels
http://www.health-service.gov/articles/sleep https://wiki.mountaineers.org/en/Mountain http://science.academy.eu/de/biologie/zellen
https://school.madrid.es/matematicas/tareas http://journal.culture.fr/theatre/2019 https://m.sportsdaily.com/football/scores
http://garden.rosegrowers.org/plants/roses.html https://music.jazzclub.net/albums/jazz http://travel.islands.com/guides/ferry https://history.archive.org/letters/1891
http://city.council.gov.uk/planning/roads https://cooking.grandmother.it/ricette/pasta https://www.nytimes.com/2021/05/04/science/bees.html
https://www.theguardian.com/environment/2020/rivers https://arxiv.org/abs/1706.03762 https://docs.python.org/3/library/json.html https://github.com/apache/spark/pulls
https://stackoverflow.com/questions/11227809 https://www.nature.com/articles/s41586-020 https://www.nasa.gov/missions/artemis https://www.nhs.uk/conditions/asthma
https://plato.stanford.edu/entries/kant https://www.gutenberg.org/ebooks/1342 https://de.wiktionary.org/wiki/Wasser https://fr.wikisource.org/wiki/Candide
https://www.lemonde.fr/culture/article/2020 https://www.spiegel.de/wissenschaft/natur https://elpais.com/cultura/2021/libros.html https://www.reuters.com/world/europe
https://apnews.com/article/floods-rescue https://www.w3.org/TR/html52/ https://developer.mozilla.org/en-US/docs/Web/HTML https://www.rfc-editor.org/rfc/rfc9110
https://www.kernel.org/doc/html/latest https://www.gov.uk/guidance/passport https://europa.eu/youth/node/12 https://www.un.org/en/about-us
https://www.who.int/news-room/fact-sheets https://www.allrecipes.com/recipe/20144/banana-bread https://www.imdb.com/title/tt0068646
https://www.goodreads.com/book/show/1885 https://www.ikea.com/gb/en/cat/sofas https://support.microsoft.com/en-us/windows https://www.mozilla.org/en-US/firefox
https://www.debian.org/releases/stable https://pypi.org/project/numpy https://news.ycombinator.com/item?id=8863 https://medium.com/@writer/on-writing-well-12
https://lists.gnu.org/archive/html/emacs https://www.jstor.org/stable/2709 https://www.khanacademy.org/math/algebra https://ocw.mit.edu/courses/linear-algebra
https://www.coursera.org/learn/statistics https://www.loc.gov/collections/maps https://www.bristolpost.co.uk/news/local-news
https://www.chicagotribune.com/sports/baseball https://www.sfgate.com/food/article https://www.seattletimes.com/opinion https://www.smh.com.au/lifestyle/gardening
https://www.irishtimes.com/culture/stage https://www.yale.edu/admissions https://www.ox.ac.uk/research https://www.uni-heidelberg.de/de/studium
https://www.sorbonne-universite.fr/formations https://www.uv.es/facultat/biologia https://www.ethz.ch/en/campus https://www.metoffice.gov.uk/weather/forecast
https://www.nps.gov/yell/planyourvisit https://www.rijksmuseum.nl/en/collection https://www.louvre.fr/visiter https://www.prado.es/coleccion
https://www.tate.org.uk/art/artists https://www.cyclinguk.org/route-guides https://www.rspb.org.uk/birds/robin https://www.bahn.de/fahrplan
https://www.sncf.com/fr/itineraire https://www.renfe.com/es/horarios https://www.amtrak.com/train-routes https://www.kingarthurbaking.com/recipes/rolls
https://www.chefkoch.de/rezepte/kuchen https://www.marmiton.org/recettes/tarte https://www.recetasgratis.net/paella https://www.gardenersworld.com/how-to/prune
https://www.diynetwork.com/how-to/shelves https://www.openstreetmap.org/node/21 https://archive.org/details/moby-dick https://www.gnu.org/software/sed/manual
https://www.sqlite.org/lang.html https://www.rust-lang.org/learn https://go.dev/doc/tutorial https://www.mayoclinic.org/diseases/asthma https://www.redcross.org/volunteer
https://www.nobelprize.org/prizes/physics https://www.fao.org/fisheries https://www.imf.org/en/publications https://www.oecd.org/education https://www.chess.com/lessons
https://www.letterboxd.com/film/casablanca https://www.discogs.com/release/249504 https://www.lego.com/en-gb/themes https://www.patagonia.com/stories
https://www.zara.com/fr/magasins http://blog.martins-boatyard.co.uk/2018/launch http://www.stpauls-parish.org/choir https://www.millfield-primary.sch.uk/newsletter
http://m.lakeside-dental.com/opening-hours https://www.volunteer-fire-company.org/roster http://blog.harriets-quilts.com/patterns https://blog.python.org/2021/10
https://blog.mozilla.org/en/products https://blog.cloudflare.com/fr-fr/dns https://blog.ted.com/ideas https://blog.archive.org/2020/maps https://blog.oup.com/2019/words
https://blog.wikimedia.de/2018/freiwillige https://blog.nationalarchives.gov.uk/letters
"""
LABELLED = tuple((u, y) for y, urls in ((1, BLOCKED), (0, ALLOWED)) for u in urls.split())


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> Column:
    """struct(rule, block) of the longest rule whose host is the host or a parent of it and whose path starts the path; null if none fits."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.text).alias("rule"), F.lit(r.block).alias("block"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("struct<rule: string, block: boolean>") if out is None else out


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, each marked with where it comes from."""
    parts = []
    for mark, part in (("h", host), ("p", path)):
        s = F.concat(F.lit("^"), part, F.lit("$"))
        for n in GRAMS:
            cut = _cut(s, n, mark)
            parts.append(F.when(F.length(s) >= n, cut).otherwise(F.array().cast("array<string>")))
    return F.concat(*parts)


def _cut(s: Column, n: int, mark: str) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(s) - (n - 1)), lambda i: F.concat(F.lit(mark + ":"), F.substr(s, i, F.lit(n))))


_TF = {"numFeatures": BUCKETS, "binary": True, "inputCol": "grams", "outputCol": "features"}


#: The share of pages that are to be blocked, as a first guess: labelled URLs weigh so that classes stand like this, and a page without a sign of either
#: is allowed.
BLOCKED_SHARE = 0.3


def fit(spark: SparkSession, labelled: tuple[tuple[str, int], ...] = LABELLED, blocked_share: float = BLOCKED_SHARE) -> LogisticRegressionModel:
    n = [sum(y == k for _, y in labelled) for k in (0, 1)]
    weigh = [(1 - blocked_share) / n[0] * len(labelled), blocked_share / n[1] * len(labelled)]
    rows = spark.createDataFrame([(u, float(y), weigh[y]) for u, y in labelled], "url string, label double, weight double").coalesce(1)
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))).withColumn("grams", grams(F.col("host"), F.col("path")))
    return LogisticRegression(maxIter=60, regParam=REGULAR, elasticNetParam=0.0, weightCol="weight").fit(HashingTF(**_TF).transform(rows))


def judge(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, model: LogisticRegressionModel | None = None, threshold: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of (page_id, url).

    A rule that fits decides; else the page is blocked if the model's probability is at least ``threshold``. ``score`` is that probability
    whether or not a rule fits. Null urls and urls without ``://`` have empty host and path and go to the model like others. Repeated rows
    each come back; an empty table gives an empty result; other columns are ignored.
    """
    model = model or fit(pages.sparkSession)
    p = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    p = p.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules)).withColumn("grams", grams(F.col("host"), F.col("path")))
    p = model.transform(HashingTF(**_TF).transform(p)).withColumn("score", vector_to_array("probability")[1])
    blocked = F.coalesce(F.col("hit.block"), F.col("score") >= threshold)
    return p.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.when(blocked, "block").otherwise("allow").alias("verdict"), "score")
