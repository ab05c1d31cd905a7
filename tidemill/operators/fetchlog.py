"""Analytics of a request log: pacing, blocks, retries, robots rules, statistics."""


import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.udf import pandas

# Status codes that are worth a retry, that a block may have, and what a challenge page says.
RETRYABLE = (429, 500, 502, 503, 504)
BLOCKING = (403, 429, 503)
MARKERS = ("captcha", "cf-chl", "challenge-platform", "attention required", "unusual traffic", "are you a robot")


def looks_blocked(status: Column, body: Column) -> Column:
    """A status that blocks and a marker at the beginning of the page (where challenge pages have it)."""
    return status.isin(*BLOCKING) & F.lower(F.substring(F.coalesce(body, F.lit("")), 1, 8000)).rlike("|".join(MARKERS))


#: Requests of one host that a single window task may take, about; a host with more is cut into ranges of its order.
PART_ROWS = 1 << 20
#: Large hosts that are broadcast at most, and cuts that a request is compared with at a time.
MOST_HOSTS, STRIDE = 100_000, 64


def _below(cuts: list[float], at: Column) -> Column:
    """How many of the sorted cuts lie at or below `at`, in two steps: strides first, then within one."""
    listed = lambda some: F.array(*map(F.lit, some)).cast("array<double>")
    count = lambda some: F.size(F.filter(some, lambda c: c <= at))
    coarse = F.greatest(count(listed(cuts[::STRIDE])) - 1, F.lit(0)) * STRIDE
    return coarse + count(F.slice(listed(cuts), coarse + 1, F.lit(STRIDE)))


def _in_ranges(requests: DataFrame, host: str, order: str) -> DataFrame | None:
    """requests with _range: 0, or for hosts of over PART_ROWS requests the stretch of order that a request falls in.

    There are as many stretches as it takes for each to hold fewer requests than that, of all large hosts together; so a
    host whose requests come at once is cut as well. None if no host is large.
    """
    sizes = requests.groupBy(F.col(host).alias("_h")).agg(F.count("*").alias("_n")).filter(F.col("_n") > PART_ROWS)
    large = sizes.agg(F.count("*").alias("hosts"), F.sum("_n").alias("rows")).first()
    if not large["hosts"]:
        return None
    sizes = F.broadcast(sizes) if large["hosts"] <= MOST_HOSTS else sizes
    rows = requests.join(sizes, F.col(host).eqNullSafe(F.col("_h")), "left")
    at, n = F.col(order).cast("double"), 1 + 2 * large["rows"] // PART_ROWS
    cuts = rows.filter("_n is not null").agg(F.percentile_approx(at, F.array(*(F.lit(i / n) for i in range(1, n))), 10 * n).alias("c")).first()["c"] or []
    return rows.withColumn("_range", F.when(F.col("_n").isNull(), 0).otherwise(_below(sorted(set(cuts)), at))).drop("_h", "_n")


def paced(requests: DataFrame, host: str, order: str, arrival: Column, interval: Column) -> DataFrame:
    """requests with slot: each host's requests at least its interval apart, in order.

    slot_i = max(arrival_i, slot_(i-1) + d) in closed form: i * d + the running maximum of arrival_j - j * d. Within a host
    that one task can take this is one window. Large hosts are cut into ranges of order: count and maximum are carried from
    range to range (a prefix scan over one row for each range), so no task has to sort all of a host's requests.
    """
    ranges = _in_ranges(requests, host, order)
    rows = requests.withColumn("_range", F.lit(0)) if ranges is None else ranges
    rows = rows.withColumn("_d", interval).withColumn("_arrival", arrival)
    own = Window.partitionBy(host, "_range").orderBy(order)
    rows = rows.withColumn("_i", F.row_number().over(own) - 1)
    free = F.col("_arrival") - F.col("_i") * F.col("_d")
    rows = rows.withColumn("_top", F.max(free).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    if ranges is None:
        return rows.withColumn("slot", F.col("_i") * F.col("_d") + F.col("_top")).select(*requests.columns, "slot")
    whole = rows.groupBy(host, "_range").agg(F.count("*").alias("_n"), F.max(free).alias("_m"), F.first("_d").alias("_d"))
    before = Window.partitionBy(host).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.withColumn("_count", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    whole = whole.withColumn("_most", F.max(F.col("_m") - F.col("_count") * F.col("_d")).over(before))
    both = rows.join(whole.select(F.col(host).alias("_host"), F.col("_range").alias("_r"), "_count", "_most"), F.col(host).eqNullSafe(F.col("_host")) & (F.col("_range") == F.col("_r")))
    slot = (F.col("_count") + F.col("_i")) * F.col("_d") + F.greatest(F.col("_most"), F.col("_top") - F.col("_count") * F.col("_d"))
    return both.withColumn("slot", slot).select(*requests.columns, "slot")


def blocked_before(requests: DataFrame, host: str, order: str, blocked: Column) -> DataFrame:
    """requests with fails_fast: an earlier request of the host was blocked. Only each host's first block matters."""
    first = requests.filter(blocked).groupBy(F.col(host).alias("_host")).agg(F.min(order).alias("_first"))
    both = requests.join(first, F.col(host).eqNullSafe(F.col("_host")), "left")
    return both.withColumn("fails_fast", F.coalesce(F.col(order) > F.col("_first"), F.lit(False))).select(*requests.columns, "fails_fast")


def retry_bounds(attempt: Column, told: Column, base: float = 0.5, cap: float = 60.0) -> tuple[Column, Column]:
    """The least and the most seconds to wait before a retry: a told delay, within 0 and cap, or half to all of the backoff."""
    most = F.least(F.lit(cap), F.lit(base) * F.pow(F.lit(2.0), attempt))
    kept = F.when(told.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(cap), told)))
    return F.coalesce(kept, most / 2), F.coalesce(kept, most)


def retry_delay(attempt: Column, told: Column, draw: Column, base: float = 0.5, cap: float = 60.0) -> Column:
    """Seconds to wait before a retry: between the bounds, as a draw from 0 to 1 says (a hash of the request keeps reruns equal)."""
    least, most = retry_bounds(attempt, told, base, cap)
    return least + (most - least) * draw


def told_delay(header: Column, now: Column) -> Column:
    """Seconds that a Retry-After header asks for, as a number or as an HTTP date."""
    date = F.try_to_timestamp(F.regexp_extract(header, r"(\d{1,2} \w{3} \d{4} \d{2}:\d{2}:\d{2})", 1), F.lit("d MMM yyyy HH:mm:ss"))
    return F.coalesce(header.try_cast("double"), date.cast("double") - now.cast("double"))


def outcomes(attempts: DataFrame, request: str, attempt: str, status: Column, most: int = 4) -> DataFrame:
    """One row for each request: attempts made, the last status, ok, and whether it gave up on retries.

    Attempts after the first that is not retryable, and beyond the limit, never happen.
    """
    rows = attempts.withColumn("_status", status)
    retry = F.col("_status").isin(*RETRYABLE)
    w = Window.partitionBy(request).orderBy(attempt)
    over = F.coalesce(F.max(~retry).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    rows = rows.withColumn("_over", over).withColumn("_n", F.row_number().over(w)).filter(~F.col("_over") & (F.col("_n") <= most + 1))
    done = rows.groupBy(request).agg(F.count("*").alias("attempts"), F.max_by("_status", "_n").alias("last_status"))
    return done.withColumn("ok", F.col("last_status") < 400).withColumn("exhausted", F.col("last_status").isin(*RETRYABLE) & (F.col("attempts") > most))


def statistics(log: DataFrame, status: Column) -> DataFrame:
    """status, n: the histogram of answers."""
    return log.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


COUNTERS = ("requests", "robots_requests", "retries", "failures", "bytes_received")


def totals(attempts: DataFrame, request: str, attempt: str, status: Column, robots: Column, size: Column) -> DataFrame:
    """One row: COUNTERS over all attempts, and statuses (an array of status and n, sorted by status).

    A request fails if its last attempt has no answer, or one that is worth a retry or an error.
    """
    rows = attempts.select(F.col(request).alias("_request"), F.col(attempt).alias("_attempt"), status.alias("status"), robots.alias("_robots"), size.alias("_size"))
    last = rows.groupBy("_request").agg(F.max_by(F.struct("status", "_robots"), "_attempt").alias("last"), F.count("*").alias("n"), F.sum("_size").alias("size"))
    bad = F.coalesce(F.col("last.status") >= 400, F.lit(True))
    one = last.agg(
        F.coalesce(F.sum(F.when(~F.col("last._robots"), F.col("n"))), F.lit(0)).alias("requests"),
        F.coalesce(F.sum(F.when(F.col("last._robots"), F.col("n"))), F.lit(0)).alias("robots_requests"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("retries"),
        F.count_if(bad & ~F.col("last._robots")).alias("failures"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("bytes_received"),
    )
    counted = rows.filter("status is not null").groupBy("status").agg(F.count("*").alias("n")).agg(F.sort_array(F.collect_list(F.struct("status", "n"))).alias("statuses"))
    return one.crossJoin(F.broadcast(counted))  # one row on either side


def merged(*counters: DataFrame) -> DataFrame:
    out = counters[0]
    for c in counters[1:]:
        out = out.unionByName(c)
    return out.groupBy("status").agg(F.sum("n").alias("n"))


def merged_totals(*counters: DataFrame) -> DataFrame:
    """Totals of several logs as one."""
    out = counters[0]
    for c in counters[1:]:
        out = out.unionByName(c)
    whole = out.agg(*(F.sum(c).alias(c) for c in COUNTERS), F.flatten(F.collect_list("statuses")).alias("_all"))
    codes = F.array_sort(F.array_distinct(F.transform("_all", lambda x: x["status"])))
    add = lambda code: F.aggregate(F.filter("_all", lambda x: x["status"] == code), F.lit(0).cast("long"), lambda t, x: t + x["n"])
    return whole.select(*COUNTERS, F.transform(codes, lambda code: F.struct(code.alias("status"), add(code).alias("n"))).alias("statuses"))


def origin(url: Column) -> Column:
    return F.concat(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url(url, F.lit("AUTHORITY")))


@pandas("struct<rules:array<struct<path:string,allowed:boolean>>,delay:double>")
def _rules(body: pd.Series, agent: pd.Series) -> pd.DataFrame:
    """Of each robots file the rules that hold for an agent, in order (paths decoded), and its delay."""
    from urllib.parse import unquote
    from urllib.robotparser import RobotFileParser

    def read(text, who):
        parser = RobotFileParser()
        parser.parse((text or "").splitlines())
        parser.modified()
        entry = next((e for e in [*parser.entries, parser.default_entry] if e is not None and e.applies_to(who)), None)
        delay = parser.crawl_delay(who)
        lines = [] if entry is None else entry.rulelines
        return [{"path": unquote(x.path), "allowed": bool(x.allowance)} for x in lines], None if delay is None else float(delay)

    return pd.DataFrame([read(*x) for x in zip(body, agent)], columns=["rules", "delay"])


def loaded(robots: DataFrame, agent: str) -> DataFrame:
    """origin, rules, delay: each robots file (origin, status, body) read once. No answer or an error of the server forbids
    everything, any other error nothing."""
    read = robots.withColumn("_r", _rules(F.col("body"), F.lit(agent)))
    every = lambda allowed: F.array(F.struct(F.lit("/").alias("path"), F.lit(allowed).alias("allowed")))
    status = F.col("status")
    rules = F.when(status.isNull() | (status >= 500), every(False)).when(status >= 400, every(True)).otherwise(F.col("_r.rules"))
    return read.select("origin", rules.alias("rules"), F.when(status < 400, F.col("_r.delay")).alias("delay"))


def permitted(urls: DataFrame, url: str, robots: DataFrame, agent: str, rate: float) -> DataFrame:
    """urls with allowed and interval (seconds). robots: origin, status (null: unreachable), body; none at all counts as 404.

    The first rule whose path begins the URL's path (both decoded) decides; without one it is allowed.
    """
    rows = urls.withColumn("origin", origin(F.col(url))).join(loaded(robots, agent), "origin", "left")
    path = F.regexp_replace(F.col(url), r"^[^:/?#]+://[^/?#]*", "")
    path = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    path = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    hit = F.get(F.filter(F.col("rules"), lambda r: (r["path"] == "*") | F.startswith(path, r["path"])), 0)
    return rows.withColumn("allowed", F.coalesce(hit["allowed"], F.lit(True))).withColumn("interval", F.greatest(F.lit(1 / rate), F.coalesce("delay", F.lit(0.0)))).drop("rules", "delay")
