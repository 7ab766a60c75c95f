"""Verdicts of robots.txt files on urls."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

VERDICT = "allowed boolean, status string, crawl_delay double"


def verdict(url: Column, code: Column, robots_txt: Column, agent: str) -> Column:
    """allowed, status (allowed, disallowed, unavailable), crawl_delay of a url under the robots.txt of its host.

    No answer (null code): unavailable, allowed. A server error forbids all, a client error or a null text allows all.
    Rules of the agent come before those of `*`. Each text is parsed once a batch.
    """

    @F.pandas_udf(VERDICT)
    def judged(urls: pd.Series, codes: pd.Series, texts: pd.Series) -> pd.DataFrame:
        from urllib.robotparser import RobotFileParser

        parsed, out = {}, []
        for u, c, t in zip(urls, codes, texts):
            if pd.isna(c):
                out.append((True, "unavailable", None))
                continue
            text = "User-agent: *\nDisallow: /" if c >= 500 else (t or "") if c < 400 else ""
            rules = parsed.get(text)
            if rules is None:
                rules = parsed[text] = RobotFileParser()
                rules.parse(text.splitlines())
            allowed = rules.can_fetch(agent, u or "")
            delay = rules.crawl_delay(agent)
            delay = rules.crawl_delay("*") if delay is None else delay
            out.append((allowed, "allowed" if allowed else "disallowed", None if delay is None else float(delay)))
        return pd.DataFrame(out, columns=["allowed", "status", "crawl_delay"]).astype({"crawl_delay": "float64"})

    return judged(url, code, robots_txt)
