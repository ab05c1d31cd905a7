"""Polite requests: paced by host, allowed by robots files, retried with growing waits, stopped by a challenge page.

A host's requests go through one session, in order: nothing else could keep them apart in time. fetched() runs the sessions
of all hosts side by side, one task for some hosts each, and streams rows through, so that a host with most of the requests
takes long but no memory. What carries a request is a function (Request to Answer): direct() uses the standard library, tests
and replays give their own.
"""

from __future__ import annotations

import http.cookies
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from email.utils import parsedate_to_datetime
from urllib.parse import urlencode, urljoin, urlsplit
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.fetchlog import BLOCKING, MARKERS, RETRYABLE, origin
from tidemill.sources.dom import Node, parse


@dataclass(frozen=True)
class Request:
    method: str
    url: str
    headers: dict[str, str] = field(default_factory=dict)
    body: bytes | None = None


@dataclass(frozen=True)
class Answer:
    status: int
    headers: dict[str, str]
    body: bytes

    @property
    def text(self) -> str:
        return self.body.decode("utf-8", "replace")


@dataclass(frozen=True)
class Manners:
    agent: str = "tidemill"
    #: Requests to one host in a second, retries of a request, seconds of the first wait and of the longest, seconds until a request is given up.
    rate: float = 8.0
    retries: int = 4
    base: float = 0.5
    cap: float = 60.0
    timeout: float = 30.0
    robots: bool = True


class Blocked(Exception):
    """A host answered with a challenge page; nothing more is asked of it."""


class Forbidden(Exception):
    """The host's robots file forbids the URL."""


class Failed(Exception):
    """No answer, or an error that stayed after all retries."""


def direct(request: Request, timeout: float = 30.0) -> Answer:
    told = urllib.request.Request(request.url, request.body, request.headers, method=request.method)
    opener = urllib.request.build_opener(urllib.request.HTTPRedirectHandler())
    try:
        with opener.open(told, timeout=timeout) as got:
            return Answer(got.status, {k.lower(): v for k, v in got.headers.items()}, got.read())
    except urllib.error.HTTPError as e:
        return Answer(e.code, {k.lower(): v for k, v in e.headers.items()}, e.read())


class Session:
    """Requests to one host, one after another, with its cookies."""

    def __init__(self, manners: Manners = Manners(), transport: Callable[[Request], Answer] = direct, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep, draw: Callable[[], float] = random.random):
        self.manners, self.transport, self.clock, self.sleep, self.draw = manners, transport, clock, sleep, draw
        self.cookies: dict[str, str] = {}
        self.interval, self.free, self.blocked = 1 / manners.rate, None, False
        self.rules: RobotFileParser | None = None
        self.stats = dict.fromkeys(("requests", "robots_requests", "retries", "failures", "bytes_received"), 0)

    def _send(self, request: Request, counter: str) -> Answer:
        now = self.clock()
        if self.free is not None and now < self.free:
            self.sleep(self.free - now)
            now = self.free
        self.free = now + self.interval
        self.stats[counter] += 1
        headers = {"User-Agent": self.manners.agent, **request.headers}
        if self.cookies:
            headers["Cookie"] = "; ".join(f"{k}={v}" for k, v in self.cookies.items())
        answer = self.transport(Request(request.method, request.url, headers, request.body))
        self.stats["bytes_received"] += len(answer.body)
        for morsel in http.cookies.SimpleCookie(answer.headers.get("set-cookie", "")).values():
            self.cookies[morsel.key] = morsel.value
        return answer

    def _wait(self, attempt: int, told: str | None) -> float:
        """Seconds before the next attempt: what the host says, within bounds, or half to all of a doubling wait."""
        if told:
            try:
                said = float(told)
            except ValueError:
                try:
                    said = parsedate_to_datetime(told).timestamp() - time.time()
                except (TypeError, ValueError):
                    said = None
            if said is not None:
                return min(max(said, 0.0), self.manners.cap)
        most = min(self.manners.cap, self.manners.base * 2**attempt)
        return most / 2 + most / 2 * self.draw()

    def _try(self, request: Request, counter: str) -> Answer:
        answer: Answer | None = None
        for attempt in range(self.manners.retries + 1):
            try:
                answer = self._send(request, counter)
            except OSError:
                answer = None
            if answer is not None and answer.status in BLOCKING and any(m in answer.text[:8000].lower() for m in MARKERS):
                self.blocked = True
                raise Blocked(request.url)
            if answer is not None and answer.status not in RETRYABLE:
                return answer
            if attempt < self.manners.retries:
                self.stats["retries"] += 1
                self.sleep(self._wait(attempt, answer.headers.get("retry-after") if answer else None))
        if answer is None:
            raise Failed(f"no answer from {request.url}")
        return answer

    def _allowed(self, url: str) -> bool:
        if not self.manners.robots:
            return True
        if self.rules is None:
            self.rules = RobotFileParser()
            at = urlsplit(url)
            try:
                answer = self._try(Request("GET", f"{at.scheme}://{at.netloc}/robots.txt"), "robots_requests")
                status = answer.status
            except Failed:
                status = 599
            # no answer or an error of the server forbids everything, any other error nothing
            self.rules.parse("User-agent: *\nDisallow: /".splitlines() if status >= 500 else [] if status >= 400 else answer.text.splitlines())
            self.rules.modified()
            delay = self.rules.crawl_delay(self.manners.agent)
            if delay is not None:
                self.interval = max(self.interval, float(delay))
        return self.rules.can_fetch(self.manners.agent, url)

    def request(self, request: Request) -> Answer:
        if self.blocked:
            raise Blocked(request.url)
        if not self._allowed(request.url):
            raise Forbidden(request.url)
        try:
            answer = self._try(request, "requests")
        except Failed:
            self.stats["failures"] += 1
            raise
        if answer.status >= 400:
            self.stats["failures"] += 1
            raise Failed(f"status {answer.status} from {request.url}")
        return answer

    def get(self, url: str) -> Answer:
        return self.request(Request("GET", url))

    def post(self, url: str, values: dict[str, str]) -> Answer:
        return self.request(Request("POST", url, {"Content-Type": "application/x-www-form-urlencoded"}, urlencode(values).encode()))

    def submit(self, url: str, page: str, values: dict[str, str]) -> Answer:
        """Sends the form of a page, with its hidden fields (tokens, view states) and these values."""
        form = next(iter(parse(page).select("form")), Node("form"))
        hidden = {x.attrs["name"]: x.attrs.get("value", "") for x in form.select("input[type=hidden]") if x.attrs.get("name")}
        return self.post(urljoin(url, form.attrs.get("action") or url), hidden | values)

    def login(self, url: str, values: dict[str, str]) -> Answer:
        """Opens a login page and sends its form; the session's cookies carry the login from then on."""
        return self.submit(url, self.get(url).text, values)


def postbacks(session: Session, url: str, first: str, second: str) -> Iterator[tuple[str, str, str]]:
    """(value, value, page) for a form that tells the values of its second field only after the first was sent."""
    page = session.get(url).text
    options = lambda html, name: [o.attrs["value"] for o in parse(html).select(f"select#{name} option") if o.attrs.get("value")]
    for a in options(page, first):
        after = session.submit(url, page, {first: a}).text
        for b in options(after, second):
            yield a, b, session.submit(url, after, {first: a, second: b}).text


RESULT = "n long, url string, status int, body string, attempts int, size long, outcome string"


def fetched(requests: DataFrame, manners: Manners = Manners(), transport: Callable[[Request], Answer] = direct, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """requests: n (their order), url, and values (a map; null: GET, else sent by POST). One row for each: status, body and outcome (ok,
    blocked, forbidden, failed). Lazy: write it once, so that nothing is asked twice.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        host, session = None, None
        for batch in batches:
            out = []
            for own, n, url, values in zip(batch["origin"], batch["n"], batch["url"], batch["values"], strict=True):
                if session is None or own != host:
                    host, session = own, Session(manners, transport, clock, sleep)
                before = dict(session.stats)
                answer, outcome = None, "ok"
                try:
                    answer = session.get(url) if values is None else session.post(url, dict(values))
                except Blocked:
                    outcome = "blocked"
                except Forbidden:
                    outcome = "forbidden"
                except Failed as e:
                    outcome = f"failed: {e}"
                attempts = session.stats["requests"] - before["requests"]
                out.append((n, url, answer.status if answer else None, answer.text if answer else None, attempts, session.stats["bytes_received"] - before["bytes_received"], outcome))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")]).astype({"status": "Int32"})

    rows = requests.select(origin(F.col("url")).alias("origin"), F.col("n").cast("long").alias("n"), "url", F.col("values") if "values" in requests.columns else F.lit(None).cast("map<string,string>").alias("values"))
    return rows.repartition("origin").sortWithinPartitions("origin", "n").mapInPandas(run, RESULT)
