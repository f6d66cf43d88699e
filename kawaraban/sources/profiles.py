"""Where each site keeps its fields, as conditions on nodes."""

from __future__ import annotations

from pyspark.sql import Column

from kawaraban.operators.folds import Wanted
from kawaraban.operators.html import is_element


class Selector(Wanted):
    """An element: tag, and a class token, the whole class text, or the id."""

    def match(self) -> Column:
        """Condition on a row of ``html.nodes``."""
        return is_element(self.tag, self.class_, self.class_exact, self.el_id)


# --- fixed values: hosts, tags and class names of the sites ---------------------
EN_BASE = "https://www.reuters.com"
EN_DAY = Selector("div", class_="headlineMed")
EN_BODY = Selector("div", class_="StandardArticleBody_body")

JA_BASE = "https://jp.reuters.com"
JA_LIST = Selector("div", class_="news-headline-list")
JA_ARCHIVE = "https://jp.reuters.com/news/archive/?view=page&page=%d&pageSize=10"

TECH_BASE = "https://www.nikkei.com"
TECH_MAIN = Selector("div", el_id="CONTENTS_MAIN")
TECH_ITEM = Selector("div", class_="m-miM09")
TECH_TITLE = Selector("span", class_="m-miM09_titleL")
TECH_TIME = Selector("dd", class_="cmnc-publish")
TECH_BODY = Selector("div", class_exact="cmn-article_text a-cf JSID_key_fonttxt m-streamer_medium")

PROPERTY_BASE = "https://tech.nikkeibp.co.jp"
PROPERTY_MAIN = Selector("div", el_id="mainContent")
PROPERTY_SECTION = Selector("section", class_exact="section article-index")
PROPERTY_PICKUP = Selector("section", class_="pickup-nfm")
PROPERTY_LIST = Selector("ul", class_="list-type1")
PROPERTY_SUMMARY = Selector("p", class_="summary")
# --------------------------------------------------------------------------------
