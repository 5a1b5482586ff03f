"""Job boards that answer in HTML.

Cards and their fields are read where a page is scanned, and only small structs of them leave the helper,
so no page becomes a node array in Spark.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.functions import dates, job_types, locations, remote, salary, urls
from vacancia.functions.arrays import with_once
from vacancia.functions.markdown import convert_if_html, formatted
from vacancia.functions.markup import Page, both, find_all, has_class, html_nodes, page_records, script_bodies, tag
from vacancia.functions.text import WHITESPACE, extract_emails, first_match, let, non_empty, rx
from vacancia.lookups import POSTING_URL
from vacancia.schema import location, posting_columns
from vacancia.sources.payloads import ParseOptions, has_text, rejects

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class CardSource:
    """How to read one kind of page. Good and unreadable cards come out of the same expression."""

    card: Callable[[Column], Column]  # node array -> array of card nodes
    fields: Callable[[Column, Column], Column]  # (node array, card) -> what the card says
    required: Callable[[Column], Column]  # what a card says -> has what a posting needs
    nodes: Callable[[Column], Column] = html_nodes  # page -> node array

    def _read(self, nodes: Column) -> Column:
        return F.transform(self.card(nodes), lambda c: self.fields(nodes, c))

    def cards(self, raw: DataFrame) -> DataFrame:
        """One row ``seq, url, company, pos, card<...>`` per card that has what a posting needs."""
        pages = raw.withColumn("nodes", self.nodes(F.col("payload")))
        read = F.posexplode(self._read(F.col("nodes"))).alias("pos", "card")
        return pages.select("seq", "url", "company", read).where(self.required(F.col("card")))

    def rejects(self, nodes: Column, payload: Column) -> Column:
        """The page's cards that lack a field, or the page where it has no card."""
        return rejects(payload, self._read(nodes), self.required)

    def quarantine(self, raw: DataFrame) -> DataFrame:
        """``seq, pos, reason, payload`` of unreadable cards and of pages without any."""
        pages = raw.withColumn("nodes", self.nodes(F.col("payload")))
        return pages.select("seq", F.inline(self.rejects(F.col("nodes"), F.col("payload"))))


def _struct(**fields: Column) -> Column:
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def _read_beside(
    read: Callable[[Page], list[tuple]], required: Callable[[Column], Column],
    said: Callable[[Column], Column] = lambda card: card, **fields: str,
) -> CardSource:
    """Cards that are read where a page is scanned: they take the place of the nodes, and no other part leaves the helper."""
    return CardSource(lambda cards: cards, lambda cards, card: said(card), required, page_records(read, **fields))


def _one_record(raw: DataFrame, records: Callable[[Column], Column]) -> DataFrame:
    """Adds the fields of the one record that is read of each page."""
    return raw.withColumn("found", records(F.col("payload"))).select("*", F.inline(F.filter("found", lambda f: F.lit(True))))


# ---- LinkedIn ---------------------------------------------------------------------------------

def _linkedin_cards(page: Page) -> list[tuple]:
    """What each card of a page says."""
    cards = []
    for card in page.find_all(page.whole(), "div", "base-search-card"):
        inner = page.inside(card)
        link = page.find(inner, "a", "base-card__full-link")
        subtitle = page.find(inner, "h4", "base-search-card__subtitle")
        company = page.find(page.inside(subtitle), "a")
        meta = page.find(inner, "div", "base-search-card__metadata")
        below = page.inside(meta)
        place = page.find(below, "span", "job-search-card__location")
        day = page.attr(page.find(below, "time", "job-search-card__listdate"), "datetime")
        if day is None:
            day = page.attr(page.find(below, "time", "job-search-card__listdate--new"), "datetime")
        pay = page.find(inner, "span", "job-search-card__salary-info")
        title = page.find(inner, "span", "sr-only")
        cards.append((
            page.attr(link, "href"), page.text(title), page.text(company), page.attr(company, "href"),
            meta is not None, page.text(place, " "), day, page.text(pay, " "),
        ))
    return cards


LINKEDIN = _read_beside(
    _linkedin_cards, lambda c: has_text(c["href"]), href="string", title="string", company="string", company_href="string",
    has_meta="boolean", place="string", day="string", pay="string",
)


def parse_linkedin_cards(raw: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    """Search cards. Details come from :func:`parse_linkedin_detail` by a join on the id."""
    o = options or ParseOptions()

    cards = LINKEDIN.cards(raw)
    c = F.col("card")
    native = urls.job_id_of_href(c["href"])
    title = F.coalesce(c["title"], F.lit("N/A"))
    home = o.canonical_country
    place = F.when(c["has_meta"], locations.loc_linkedin(c["place"], home)).otherwise(
        location(None, None, F.lit(home))
    )
    return cards.select(
        *posting_columns(
            seq=F.col("seq"),
            pos=F.col("pos"),
            site=F.lit("linkedin"),
            id=F.concat(F.lit("li-"), native),
            title=title,
            company_name=F.coalesce(c["company"], F.lit("N/A")),
            company_id=first_match(F.col("url"), r"[?&]f_C=(\d+)(?:[&#]|$)"),  # a search for one company
            company_url=F.coalesce(urls.strip_query(c["company_href"]), F.lit("")),
            location=place,
            is_remote=remote.remote_keywords3(title, locations.display_location(place)),
            date_posted=dates.strict_date(c["day"]),
            job_url=urls.posting_url(F.lit("linkedin"), native),
            compensation=salary.linkedin_salary(c["pay"]),
            job_level=F.lit(""),
        )
    )


def _linkedin_job(page: Page) -> list[tuple]:
    """What a detail page says: one record."""
    whole = page.whole()
    headings = [(n, page.text(n)) for n in page.find_all(whole, "h3")]
    criteria = [h for h in headings if "description__job-criteria-subheader" in page.classes(h[0]).split(" ")]

    def criterion(label: str) -> str | None:
        """Text of the criterion that follows a heading with the label."""
        head = next((n for n, text in criteria if label in text), None)
        for n in page.siblings_after(head):
            if page.tags[n] == "span" and page.classes(n) == "description__job-criteria-text description__job-criteria-text--criteria":
                return page.text(n) or None
        return None

    below = page.following(next((n for n, text in headings if "Job function" in text), None))
    bodies = (n for n in page.find_all(whole, "div") if "show-more-less-html__markup" in page.classes(n).lower())
    codes = (n for n in page.find_all(whole, "code") if page.attr(n, "id") == "applyUrl")
    return [(
        page.outer_html(next(bodies, None)),
        criterion("Seniority level"),
        criterion("Industries"),
        criterion("Employment type"),
        page.text(page.find(below, "span", "description__job-criteria-text"), " "),
        page.attr(page.find(whole, "img", "artdeco-entity-image"), "data-delayed-url"),
        page.outer_html(next(codes, None)),
    )]


_linkedin_jobs = page_records(
    _linkedin_job, body="string", level="string", company_industry="string", kind="string", job_function="string",
    company_logo="string", apply="string",
)


def parse_linkedin_detail(raw: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    """Detail fields by id (taken from the payload's URL)."""
    o = options or ParseOptions()
    fields = _one_record(raw, _linkedin_jobs)
    kind = F.lower(F.replace("kind", F.lit("-"), F.lit("")))
    return fields.select(
        "seq",
        F.concat(F.lit("li-"), F.element_at(F.split("url", "/"), -1)).alias("id"),
        formatted(F.col("body"), o.description_format).alias("description"),
        F.lower("level").alias("job_level"),
        "company_industry",
        F.filter(F.array(job_types.job_type_of(kind)), lambda t: t.isNotNull()).alias("job_type"),
        "job_function",
        "company_logo",
        urls.unquote_direct_url(F.col("apply")).alias("job_url_direct"),
    )


# ---- ZipRecruiter and Seek detail pages -------------------------------------------------------

def _zip_job(page: Page) -> list[tuple]:
    """Description and firm of a detail page: one record."""
    whole = page.whole()
    parts = page.find(whole, "div", "job_description"), page.find(whole, "section", "company_description")
    return [("".join(page.outer_html(n) or "" for n in parts) or None,)]


_zip_jobs = page_records(_zip_job, body="string")


def parse_ziprecruiter_detail(raw: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    """Full description and direct link by id (the ``lvk`` of the payload's URL)."""
    o = options or ParseOptions()
    fields = _one_record(raw, _zip_jobs)
    state = F.get(script_bodies(F.col("payload"), "application/json"), F.lit(0))
    return fields.select(
        "seq",
        F.concat(F.lit("zr-"), first_match(F.col("url"), r"lvk=([^&#]+)")).alias("id"),
        formatted(F.col("body"), o.description_format).alias("description"),
        first_match(F.get_json_object(state, "$.model.saveJobURL"), r"job_url=(.+)")
        .alias("job_url_direct"),
    )


def _seek_job(page: Page) -> list[tuple]:
    """Description of a detail page: one record. A marked span wins over a marked div."""
    bodies = (page.having(page.whole(), "data-automation", "jobAdDetails", name) for name in ("span", "div"))
    return [(page.outer_html(next((n for n in bodies if n is not None), None)),)]


_seek_jobs = page_records(_seek_job, body="string")


def parse_seek_detail(raw: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    """Full description by id (last path part of the payload's URL)."""
    o = options or ParseOptions()
    fields = _one_record(raw, _seek_jobs)
    return fields.select(
        "seq",
        F.element_at(F.split("url", "/"), -1).alias("id"),
        formatted(F.col("body"), o.description_format).alias("description"),
    )


# ---- Bayt -------------------------------------------------------------------------------------

def _bayt_cards(page: Page) -> list[tuple]:
    """What each card of a page says."""
    cards = []
    for card in page.find_all(page.whole(), "li"):
        if page.attr(card, "data-js-job") != "":
            continue
        inner = page.inside(card)
        head = page.find(inner, "h2")
        firm = page.first(inner, lambda n: page.classes(n) == "t-nowrap p10l", "div")
        place = page.first(inner, lambda n: page.classes(n) == "t-mute t-small", "div")
        href = page.attr(page.find(page.inside(head), "a"), "href")
        cards.append((
            page.text(head), None if href is None else href.strip(WHITESPACE),
            page.text(page.find(page.inside(firm), "span")), page.text(place),
        ))
    return cards


BAYT = _read_beside(
    _bayt_cards, lambda c: has_text(c["href"]), title="string", href="string", company="string", place="string",
)


def parse_bayt(raw: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    cards = BAYT.cards(raw)
    c = F.col("card")
    url = F.concat(F.lit("https://www.bayt.com"), c["href"])
    return cards.select(
        *posting_columns(
            seq=F.col("seq"),
            pos=F.col("pos"),
            site=F.lit("bayt"),
            id=F.concat(F.lit("bayt-"), urls.url_hash(url)),
            title=c["title"],
            company_name=c["company"],
            location=location(c["place"], None, F.lit("worldwide")),
            job_url=url,
        )
    )


# ---- BDJobs -----------------------------------------------------------------------------------

# Card classes in order of preference.
BDJOBS_CARDS = ("job-item", "sout-jobs-wrapper", "norm-jobs-wrapper", "featured-wrap")


def first_matching_selector(nodes: Column, classes: tuple[str, ...]) -> Column:
    """``struct<rank, cards>`` of the first class any div has; rank null when none has."""
    found = F.array(
        *[
            _struct(rank=F.lit(rank), cards=find_all(nodes, both(tag("div"), has_class(name))))
            for rank, name in enumerate(classes)
        ]
    )
    return F.get(F.filter(found, lambda s: F.size(s["cards"]) > 0), F.lit(0))


def _bdjobs_cards(page: Page) -> list[tuple]:
    """What each card of a page says: cards by class, else whatever encloses a detail link."""

    def detail_links(nodes: range) -> Iterator[int]:
        return (n for n in page.find_all(nodes, "a") if "jobdetail" in (page.attr(n, "href") or "").lower())

    def by_class(*names: str) -> str | None:
        return page.text(page.class_like(inner, names, "span", "div"))

    whole, found = page.whole(), []
    for name in BDJOBS_CARDS:
        if found := list(page.find_all(whole, "div", name)):
            break
    cards = []
    for card in found or [page.parents[n] for n in detail_links(whole) if page.parents[n] >= 0]:
        inner = page.inside(card)
        link = next(detail_links(inner), None)
        heading = page.first(inner, lambda n: "job-title-text" in page.classes(n).split(" "), "h2", "h3", "h4", "strong", "div")
        title = page.text(link) or page.text(heading)
        company = by_class("comp-name-text")
        if company is None:
            company = by_class("company", "org", "comp-name")
        place = by_class("locon-text-d")
        if place is None:
            place = by_class("location", "area", "locon")
        cards.append((
            page.attr(link, "href"), "N/A" if title is None else title, "N/A" if company is None else company,
            "Dhaka, Bangladesh" if place is None else place, by_class("date", "deadline", "published"),
        ))
    return cards


BDJOBS = _read_beside(
    _bdjobs_cards, lambda c: has_text(c["href"]), href="string", title="string", company="string", place="string", day="string",
)


def parse_bdjobs_cards(raw: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    cards = BDJOBS.cards(raw)
    c = F.col("card")
    url = urls.absolute_url(c["href"], F.lit("https://jobs.bdjobs.com"))
    native = F.when(
        F.contains(url, F.lit("jobid=")),
        F.substring_index(F.substring_index(url, "jobid=", -1), "&", 1),
    ).otherwise(F.concat(F.lit("bdjobs-"), urls.url_hash(url)))
    place = locations.loc_two_parts(c["place"], "bangladesh")
    return cards.select(
        *posting_columns(
            seq=F.col("seq"),
            pos=F.col("pos"),
            site=F.lit("bdjobs"),
            id=native,
            title=c["title"],
            company_name=c["company"],
            location=place,
            date_posted=dates.deadline_date(c["day"]),
            job_url=url,
            is_remote=remote.remote_bdjobs(c["title"], locations.display_location(place)),
        )
    )


def _bdjobs_duties(page: Page, head: int | None) -> str:
    """Lines of the lists and paragraphs after a heading, up to the next one."""
    lines = []
    for n in page.siblings_after(head):
        if page.tags[n] in ("hr", "h4", "h5"):
            break
        if page.tags[n] == "ul":
            lines.extend(page.text(li, " ") for li in page.find_all(page.inside(n), "li"))
        elif page.tags[n] == "p":
            lines.append(page.text(n, " "))
    return "\n".join(lines)


def _bdjobs_job(page: Page) -> list[tuple]:
    """What a detail page says: one record."""
    whole, tags = page.whole(), page.tags
    boxes = [n for n in whole if tags[n] in ("span", "div")]
    said = [(n, text.lower()) for n in boxes if (text := page.single_string(n)) is not None]

    def labelled(*labels: str) -> str | None:
        """Text of the element after the first one whose only text names a label."""
        label = next((n for n, text in said if any(x in text for x in labels)), None)
        return page.text(next((n for n in boxes if label is not None and n > label), None)) or None

    content = page.inside(page.find(whole, "div", "jobcontent"))
    head = page.having(content, "id", "job_resp", "h4")
    if head is None:
        titles = (n for n in content if tags[n] in ("h4", "h5"))
        head = next((n for n in titles if "responsibilities" in (page.single_string(n) or "").lower()), None)
    block = page.class_like(whole, ("job-description", "details", "requirements"), "div", "section")
    return [(
        _bdjobs_duties(page, head) or None, page.outer_html(block),
        labelled("job type", "employment type"), labelled("industry"),
    )]


_bdjobs_jobs = page_records(_bdjobs_job, listed="string", block="string", kind="string", company_industry="string")


def parse_bdjobs_detail(raw: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    """Responsibilities (or the description block), job type and industry by id."""
    o = options or ParseOptions()
    fields = _one_record(raw, _bdjobs_jobs)
    wanted = F.when(F.col("listed").isNull(), F.col("block"))
    style = "markdown" if o.description_format == "markdown" else "html"
    return fields.select(
        "seq",
        first_match(F.col("url"), r"jobid=([^&]*)").alias("id"),
        F.coalesce(F.col("listed"), formatted(wanted, style), F.lit("")).alias("description"),
        F.filter(
            F.array(job_types.normalize_job_type(F.col("kind"))), lambda t: t.isNotNull()
        ).alias("job_type"),
        "company_industry",
    )


# ---- IrishJobs --------------------------------------------------------------------------------

IRISH_HOME = "https://www.irishjobs.ie"


def _irish_row(rows: DataFrame, o: ParseOptions) -> DataFrame:
    """``seq, pos, card<...>`` to postings; see :func:`build_irishjobs_row`."""
    c = F.col("card")
    return build_irishjobs_row(
        rows.select(
            "seq", "pos", c["title"].alias("title"), c["url"].alias("url"),
            c["company"].alias("company"), c["place"].alias("place"), c["pay"].alias("pay"),
            c["day"].alias("day"), c["kind"].alias("kind"), c["description"].alias("description"),
        ),
        o,
    )


def _irish_cards(page: Page) -> list[tuple]:
    """What each card of a page says."""
    cards = []
    for card in [n for n, said in enumerate(page.attrs) if said and said.get("data-testid") == "job-item"]:
        inner = page.inside(card)

        def by_attr(name: str) -> str | None:
            return page.text(page.having(inner, "data-at", f"job-item-{name}"))

        link = page.having(inner, "data-testid", "job-item-title", "a")
        if link is None:
            link = page.having(inner, "data-at", "job-item-title", "a")
        kind = page.having(inner, "data-at", "job-item-type")
        if kind is None:
            kind = page.class_like(inner, ("job-type",), "span")
        cards.append((
            page.text(link), page.attr(link, "href"), by_attr("company-name"), by_attr("location"),
            by_attr("salary-info"), by_attr("timeago"), page.text(kind),
        ))
    return cards


def _irish_said(card: Column) -> Column:
    """A card with its link made absolute; cards have no description."""
    return _struct(
        title=card["title"], url=urls.absolute_url(non_empty(card["href"]), F.lit(IRISH_HOME)),
        **{name: card[name] for name in ("company", "place", "pay", "day", "kind")},
        description=F.lit(None).cast("string"),
    )


IRISH = _read_beside(
    _irish_cards, lambda c: has_text(c["title"], c["url"]), _irish_said,
    title="string", href="string", company="string", place="string", pay="string", day="string", kind="string",
)


def parse_irishjobs_cards(raw: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    """Search cards with a title and a link."""
    o = options or ParseOptions()

    cards = IRISH.cards(raw)
    return _irish_row(cards, o)


def _irish_without_cards(payload: Column) -> Column:
    return ~F.coalesce(payload.rlike(r"data-testid=[\"']job-item[\"']"), F.lit(False))


def _irish_items(payload: Column) -> Column:
    """JSON texts of a page's linked data: the entries of an item list, or postings."""

    def items(body: Column) -> Column:
        listed = F.from_json(F.get_json_object(body, "$.itemListElement"), "array<string>")
        postings = F.filter(
            F.from_json(body, "array<string>"),
            lambda p: F.get_json_object(p, "$['@type']") == "JobPosting",
        )
        return F.coalesce(
            F.when(F.get_json_object(body, "$['@type']") == "ItemList", listed),
            F.when(F.startswith(body, F.lit("[")), postings),
            F.array().cast("array<string>"),
        )

    return F.flatten(F.transform(script_bodies(payload, "application/ld+json"), items))


def quarantine_irishjobs(raw: DataFrame) -> DataFrame:
    """Unreadable cards, or entries of linked data where a page has no cards."""

    def named(item: Column) -> Column:
        return let(
            F.coalesce(F.get_json_object(item, "$.item"), item),
            lambda entry: has_text(F.get_json_object(entry, "$.title"), F.get_json_object(entry, "$.url")),
        )

    payload = F.col("payload")
    linked = rejects(payload, _irish_items(payload), named, text=lambda item: item)
    # A page without cards isn't scanned for them.
    pages = with_once(raw, bare=_irish_without_cards(payload))
    cards = IRISH.nodes(F.when(~F.col("bare"), payload))
    found = F.when(F.col("bare"), linked).otherwise(IRISH.rejects(F.col("nodes"), payload))
    return pages.withColumn("nodes", cards).select("seq", F.inline(found))


def parse_irishjobs_jsonld(raw: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    """Linked data of pages without cards: an item list, or a list of postings."""
    o = options or ParseOptions()
    rows = raw.where(_irish_without_cards(F.col("payload"))).select(
        "seq", F.posexplode(_irish_items(F.col("payload"))).alias("pos", "item")
    )
    rows = with_once(rows, entry=F.coalesce(F.get_json_object("item", "$.item"), F.col("item")))

    def get(path: str) -> Column:
        return F.get_json_object(F.col("entry"), path)

    # Each is read once: what a row needs is asked of these columns, not of the entry again.
    rows = with_once(
        rows.drop("item"),
        title=get("$.title"),
        link=get("$.url"),
        company=get("$.hiringOrganization.name"),
        place=get("$.jobLocation.address.addressLocality"),
        low=get("$.baseSalary.value.minValue"),
        high=get("$.baseSalary.value.maxValue"),
        currency=get("$.baseSalary.currency"),
        day=get("$.datePosted"),
        kind=get("$.employmentType"),
        description=get("$.description"),
    )
    low, high = F.col("low"), F.col("high")
    pay = F.when(
        has_text(F.concat_ws("", low, high)),
        F.concat(
            F.coalesce("currency", F.lit("EUR")), F.lit(" "),
            F.coalesce(low, F.lit("")), F.lit(" - "), F.coalesce(high, F.lit("")),
        ),
    )
    rows = with_once(rows, url=urls.absolute_url(non_empty(F.col("link")), F.lit(IRISH_HOME)), pay=pay)
    return build_irishjobs_row(
        rows.select("seq", "pos", "title", "url", "company", "place", "pay", "day", "kind", "description"), o
    )


def build_irishjobs_row(rows: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    """``seq, pos, title, url, company, place, pay, day, kind, description`` to postings."""
    o = options or ParseOptions()
    number = first_match(F.col("url"), r"job(\d+)")
    hashed = urls.url_hash(F.col("url"))
    template = POSTING_URL["irish_jobs"].replace("{}", "")
    text = F.col("description")
    rows = rows.where(has_text(F.col("title"), F.col("url")))
    if o.description_format == "markdown":
        rows = rows.withColumn("text", convert_if_html(text))
    else:
        rows = rows.withColumn("text", text)
    return rows.select(
        *posting_columns(
            seq=F.col("seq"),
            pos=F.col("pos"),
            site=F.lit("irish_jobs"),
            id=F.concat(F.lit("ij-"), F.coalesce(number, hashed)),
            title=F.col("title"),
            company_name=F.col("company"),
            job_url=F.coalesce(F.concat(F.lit(template), number), F.col("url")),
            location=locations.loc_two_parts(F.col("place"), "ireland"),
            description=F.col("text"),
            compensation=salary.irish_salary(F.col("pay")),
            date_posted=dates.irish_relative_date(F.col("day"), o.today),
            job_type=F.coalesce(
                job_types.job_type_irish(F.col("kind")),
                F.when(F.length(text) > 0, job_types.extract_job_type(text)),
            ),
            is_remote=remote.remote_irish(text, F.col("title"), F.col("place")),
            emails=extract_emails(F.col("text")),
        )
    )


# ---- JazzHR career pages ----------------------------------------------------------------------

def _jazzhr_cards(page: Page) -> list[tuple]:
    """What each card of a page says."""
    cards = []
    for card in page.find_all(page.whole(), "li", "list-group-item"):
        inner = page.inside(card)
        head = page.first(inner, lambda n: "list-group-item-heading" in page.classes(n).split(" "))
        link = page.find(page.inside(head), "a")
        marker = page.find(inner, "i", "fa-map-marker")
        place = "" if marker is None else page.text(page.parents[marker])
        cards.append((page.text(link), page.attr(link, "href"), place))
    return cards


JAZZHR = _read_beside(
    _jazzhr_cards, lambda c: has_text(c["title"], c["href"], urls.apply_code(c["href"])),
    title="string", href="string", place="string",
)


def parse_jazzhr(raw: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    """Listing page of a company's board; the company handle is its sub-domain."""

    cards = JAZZHR.cards(raw)
    c = F.col("card")
    handle = urls.career_slug(F.col("url"), F.lit("jazzhr"))
    code = urls.apply_code(c["href"])
    full = F.when(
        F.startswith(c["href"], F.lit("/")),
        F.concat(F.lit("https://"), handle, F.lit(".applytojob.com"), c["href"]),
    ).otherwise(c["href"])
    said = F.lower(F.concat_ws(" ", c["title"], c["place"]))
    return cards.select(
        *posting_columns(
            seq=F.col("seq"),
            pos=F.col("pos"),
            site=F.lit("jazzhr"),
            id=F.concat_ws(":", F.lit("jazzhr"), handle, code),
            title=c["title"],
            company_name=F.col("company"),
            job_url=full,
            location=locations.loc_jazzhr(c["place"]),
            is_remote=said.rlike(rx(r"\bremote\b")),
        )
    )


def _jazzhr_job(page: Page) -> list[tuple]:
    """Description of a detail page: one record."""
    return [(page.outer_html(page.having(page.whole(), "id", "job-description")),)]


_jazzhr_jobs = page_records(_jazzhr_job, body="string")


def parse_jazzhr_detail(raw: DataFrame, options: ParseOptions | None = None) -> DataFrame:
    """Description by posting URL."""
    fields = _one_record(raw, _jazzhr_jobs)
    return fields.select(
        "seq",
        F.col("url").alias("job_url"),
        formatted(F.col("body"), "markdown").alias("description"),
    )


HTML_BOARDS = {
    "linkedin": parse_linkedin_cards,
    "bayt": parse_bayt,
    "bdjobs": parse_bdjobs_cards,
    "irish_jobs": parse_irishjobs_cards,
    "jazzhr": parse_jazzhr,
}

HTML_QUARANTINE = {
    "linkedin": LINKEDIN.quarantine,
    "bayt": BAYT.quarantine,
    "bdjobs": BDJOBS.quarantine,
    "irish_jobs": quarantine_irishjobs,
    "jazzhr": JAZZHR.quarantine,
}
