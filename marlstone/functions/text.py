"""Text expressions. Built-in Spark functions, but for Unicode folding, which Spark lacks."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed values -------------------------------------------------------------------------------
EMAIL = r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
IBAN = r"(?i)\b[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]){11,30}\b"
MONEY = r"(?i)(?:\b\d[\d\s.,]*\s?(?:TND|DT|EUR|USD|FCFA|F\s?CFA)\b|(?:€|\$)\s?\d[\d\s.,]*)"
PHONE = r"(?<!\w)(?:\+\d{1,3}[ .-]?)?(?:\d[ .-]?){8,14}(?!\w)"
BRIEF_PHONE = r"(?<!\w)(?:\+?\d[\d .()/-]{7,}\d)(?!\w)"
BRIEF_MONEY = r"(?i)(?<!\w)\d[\d\s.,]{1,18}\s*(?:EUR|USD|TND|DT|F\s*CFA|€|\$)(?!\w)"
FRENCH_WORDS = ("de", "la", "le", "les", "des", "du", "un", "une", "et", "en", "pour", "dans", "sur", "par", "avec", "au", "aux", "est", "sont", "que", "qui", "ce", "cette", "ces", "nous", "notre", "leur", "leurs", "référence", "contrat")
ENGLISH_WORDS = ("the", "of", "and", "to", "in", "for", "on", "with", "is", "are", "that", "this", "these", "by", "from", "our", "their", "project", "contract", "reference")
BRIEF_FRENCH = ("le", "la", "les", "des", "pour", "avec", "doit", "devra", "mission", "référence", "reference")
BRIEF_ENGLISH = ("the", "and", "for", "with", "must", "shall", "project", "reference", "experience")
DOCUMENT_TYPES = (
    ("ATTESTATION", ("attestation", "certificate", "certificat", "lettre de référence", "شهادة", "إفادة")),
    ("MINUTES", ("procès-verbal", "proces-verbal", "p.v.", " pv ", "minutes of", "محضر")),
    ("SPECIFICATION", ("cahier des charges", "terms of reference", " cdc ", "spécification")),
    ("CONTRACT", ("contrat", "contract", "avenant", "convention", "marché", "marche", "accord", "عقد", "اتفاقية")),
)
QUERY_STOP_WORDS = ("a", "au", "aux", "avec", "ce", "ces", "dans", "de", "des", "du", "elle", "en", "et", "il", "la", "le", "les", "leur", "leurs", "mais", "ou", "où", "par", "pour", "que", "qui", "sur", "un", "une", "the", "and", "for", "from", "into", "of", "to", "with", "يجب", "من", "في", "على", "إلى")
GROUNDING_STOP_WORDS = ("avec", "dans", "pour", "sans", "sous", "plus", "moins", "entre", "ainsi", "afin", "cette", "leurs", "notre", "votre", "dont", "tout", "tous", "toute", "toutes", "être", "avoir", "faire", "mise", "place", "projet", "mission", "phase", "article", "contrat", "elaboration", "élaboration", "prestataire", "client", "banque", "the", "and", "from", "with", "this")
ARABIC_MARKS = "[ؐ-ًؚ-ٰٟۖ-ۭـ]"
ARABIC_FORMS = ("أإآٱىؤئ", "اااايوي")
# ---------------------------------------------------------------------------------------------


#: Texts that are Python strings at a time while a batch is worked on.
FOLDED_TOGETHER = 256
#: Words of queries and evidence that are remembered.
REMEMBERED = 50_000


def few_at_a_time(texts: pa.Array, kind: pa.DataType, made) -> pa.Array:
    """``made`` of slices of a few texts, put together: a batch of long texts is held in Arrow's form only."""
    parts = [made(texts.slice(i, FOLDED_TOGETHER)) for i in range(0, len(texts), FOLDED_TOGETHER)]
    return pa.concat_arrays(parts) if len(parts) > 1 else parts[0] if parts else pa.array([], kind)


def _each(texts: pa.Array, change, of_ascii) -> pa.Array:
    """``change`` of each text that is not null; ``of_ascii`` of slices that are all ASCII, which stay Arrow's."""

    def made(some: pa.Array) -> pa.Array:
        if pc.all(pc.string_is_ascii(some)).as_py() is not False:
            return of_ascii(some)
        return pa.array([None if t is None else change(t) for t in some.to_pylist()], pa.string())

    return few_at_a_time(texts, pa.string(), made)


@F.arrow_udf(StringType())
def nfkc(texts: pa.Array) -> pa.Array:
    return _each(texts, lambda t: unicodedata.normalize("NFKC", t), lambda some: some)


@F.arrow_udf(StringType())
def strip_marks(texts: pa.Array) -> pa.Array:
    """NFKC, case folding, NFKD, and no combining marks."""

    def fold(t):
        if t.isascii():
            return t.lower()
        t = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", t).casefold())
        return "".join(c for c in t if not unicodedata.combining(c))

    return _each(texts, fold, pc.ascii_lower)


def folded(text: object, keep: str = "") -> str:
    """``fold_key`` of a value on the driver, for aliases and other parameters."""
    plain = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", "" if text is None else str(text)).casefold())
    return " ".join(re.sub(f"[^a-z0-9{keep}]+", " ", "".join(c for c in plain if not unicodedata.combining(c))).split())


def squeeze(text: Column) -> Column:
    """One space for each run of white space, none at the ends; no-break spaces count."""
    return F.trim(F.regexp_replace(text, r"[\s ]+", " "))


def fold_key(text: Column, keep: str = "") -> Column:
    """Accent-free, case-free key of a-z, 0-9 and the characters in ``keep``."""
    return F.trim(F.regexp_replace(strip_marks(F.coalesce(text, F.lit(""))), f"[^a-z0-9{keep}]+", " "))


def fold_wide(text: Column) -> Column:
    """Like ``fold_key``, but every letter and digit of any script stays."""
    return F.trim(F.regexp_replace(strip_marks(F.coalesce(text, F.lit(""))), r"(?U)[^\w؀-ۿ]+", " "))


def fold_search(text: Column) -> Column:
    """Search form: Arabic marks dropped, letter variants joined, accents and case removed."""
    plain = F.regexp_replace(nfkc(F.coalesce(text, F.lit(""))), ARABIC_MARKS, "")
    return strip_marks(F.translate(plain, *ARABIC_FORMS))


def tokens(text: Column) -> Column:
    """Runs of letters and digits of the search form, two characters at least."""
    return F.filter(F.regexp_extract_all(fold_search(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)), lambda t: F.length(t) >= 2)


def text_metrics(text: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    return {
        "character_count": F.length(text).cast("long"),
        "word_count": F.regexp_count(text, F.lit(r"[\p{L}\p{N}_]+")).cast("long"),
        "line_count": F.regexp_count(text, F.lit(r"(?m)^.*\S.*$")).cast("long"),
        "latin_character_count": F.regexp_count(text, F.lit(r"\p{IsLatin}")).cast("long"),
        "arabic_character_count": F.regexp_count(text, F.lit(r"\p{IsArabic}")).cast("long"),
    }


def normalize_extracted(text: Column) -> Column:
    """NFKC, line feeds only, no control characters, trimmed lines, single blank lines."""
    t = F.regexp_replace(nfkc(F.coalesce(text, F.lit(""))), r"\r\n?", "\n")
    t = F.regexp_replace(t, r"[\p{C}&&[^\n]]", "")
    t = F.regexp_replace(F.regexp_replace(t, r"[ \t ]+", " "), r"(?m)^ +| +$", "")
    return F.btrim(F.regexp_replace(t, r"\n{3,}", "\n\n"), F.lit(" \n"))


def clean_redacted(text: Column) -> Column:
    """Words split at a line end joined, lines of marks alone dropped, single paragraph breaks kept."""
    t = F.regexp_replace(normalize_extracted(text), "(?<=[A-Za-zÀ-ÖØ-öø-ÿ])-\n(?=[a-zà-öø-ÿ])", "")
    lines = F.filter(F.split(t, "\n"), lambda x: (x == "") | ~x.rlike(r"^(?U)[\W_]+$"))
    return F.btrim(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"), F.lit(" \n"))


def redact(text: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, dict[str, Column]]:
    """The text with each pattern in turn replaced by ``[LABEL]``, and how often each was.

    Each pattern sees the text as the ones before left it. The steps are shared subexpressions, which
    Spark makes once a row where text and counts are columns of one select; a map of the counts is made of those columns.
    """
    counts = {}
    for label, pattern in rules:
        counts[label] = F.regexp_count(text, F.lit(pattern)).cast("long")
        text = F.regexp_replace(text, pattern, f"[{label}]")
    return text, counts


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value made once a row, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


PAGE_RULES = (("EMAIL", EMAIL), ("IBAN", IBAN), ("MONETARY_AMOUNT", MONEY), ("PHONE_LIKE", PHONE))
BRIEF_RULES = (("EMAIL", EMAIL), ("PHONE", BRIEF_PHONE), ("MONETARY_VALUE", BRIEF_MONEY))


def counts_map(counts: dict[str, Column]) -> Column:
    """A map of the counts above 0; pass columns that are made already, for each is used by name and value."""
    return F.map_filter(F.create_map(*[x for k, v in counts.items() for x in (F.lit(k), v)]), lambda _, v: v > 0)


def redact_mapping(values: Column, keys: list[str]) -> Column:
    """A map with the values of some keys (in any case) masked; of JSON texts see ``redact_json``."""
    return F.transform_values(values, lambda k, v: F.when(F.lower(k).isin([x.lower() for x in keys]), F.lit("[REDACTED]")).otherwise(v))


def redact_json(text: Column, keys: list[str]) -> Column:
    """A JSON text with the values of some keys masked at every depth; other texts become null."""
    import json

    named = frozenset(k.lower() for k in keys)

    def masked(value):
        if isinstance(value, dict):
            return {k: "[REDACTED]" if k.lower() in named else masked(v) for k, v in value.items()}
        return [masked(v) for v in value] if isinstance(value, list) else value

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        def one(t):
            try:
                return None if t is None else json.dumps(masked(json.loads(t)), ensure_ascii=False)
            except ValueError:
                return None

        return texts.map(one)

    return mask(text)


def count_words(text: Column, listed: tuple[str, ...]) -> Column:
    found = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
    return F.size(F.filter(found, lambda w: w.isin(*listed)))


def _listed_words(text: Column, listed: tuple[str, ...]) -> Column:
    """How many words of a text are listed, in any case."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
    return F.size(F.filter(found, lambda w: w.isin(*listed)))


def page_language(text: Column) -> Column:
    """fr, en, ar, fr-ar, en-ar or und, by share of scripts and stop words."""
    arabic, latin = F.regexp_count(text, F.lit(r"\p{IsArabic}")), F.regexp_count(text, F.lit(r"\p{IsLatin}"))
    letters = F.greatest(arabic + latin, F.lit(1))
    lead = _listed_words(text, FRENCH_WORDS) - _listed_words(text, ENGLISH_WORDS)
    shares = F.struct((arabic / letters).alias("a"), (latin / letters).alias("l"), F.when(lead >= 0, "fr").otherwise("en").alias("word"))

    def named(s: Column) -> Column:
        both = (s["a"] >= 0.18) & (s["l"] >= 0.18)
        return F.when(both, F.concat(s["word"], F.lit("-ar"))).when(s["a"] >= 0.55, "ar").when(s["l"] >= 0.40, s["word"]).otherwise("und")

    return _once(shares, named)


def brief_language(text: Column) -> Column:
    """fr, en, ar, mixed or unknown: of a short request."""
    folded = fold_wide(text)
    seen = F.array_distinct(F.split(folded, " "))
    arabic = F.regexp_count(text, F.lit(r"[؀-ۿ]"))
    latin = F.regexp_count(text, F.lit("[A-Za-zÀ-ÖØ-öø-ÿ]"))
    fr, en = (F.size(F.array_intersect(seen, F.array(*map(F.lit, w)))) for w in (BRIEF_FRENCH, BRIEF_ENGLISH))
    return F.when(folded == "", "unknown").when(arabic > F.greatest(F.lit(8.0), latin * 0.35), "ar").when((fr == 0) & (en == 0), "mixed").when(fr >= en, "fr").otherwise("en")


def document_type(file_name: Column, text: Column, rules=DOCUMENT_TYPES) -> tuple[Column, Column]:
    """(type, basis): the first keyword, in order of the rules, in the name or the first 6,000 characters."""
    hay = F.concat(F.lit(" "), F.lower(file_name), F.lit(" "), F.lower(F.substring(text, 1, 6000)), F.lit(" "))
    kind = basis = None
    for name, keywords in rules:
        for k in keywords:
            hit = hay.contains(k)
            kind = F.when(hit, name) if kind is None else kind.when(hit, name)
            basis = F.when(hit, f"keyword:{k.strip()}") if basis is None else basis.when(hit, f"keyword:{k.strip()}")
    return kind.otherwise("OTHER_EVIDENCE"), basis.otherwise("fallback:no_keyword")


def whole_words(folded_text: Column, phrases: list[str]) -> Column:
    """Whether any phrase occurs in the folded text on word boundaries."""
    padded, out = F.concat(F.lit(" "), folded_text, F.lit(" ")), F.lit(False)
    for p in phrases:
        out = out | padded.contains(f" {p} ")
    return out


def safe_file_name(name: Column) -> Column:
    t = F.regexp_replace(F.element_at(F.split(nfkc(name), r"[/\\]"), -1), r'[\\/:*?"<>|\x00-\x1f]+', "_")
    return F.substring(F.btrim(squeeze(t), F.lit(" .")), 1, 180)


def file_id(value: Column) -> Column:
    """A bare id of 20 characters or more, or the one in a URL."""
    t = F.trim(value)
    inside = F.regexp_extract(t, r"(?:/d/|/folders/|[?&]id=)([A-Za-z0-9_-]{20,})", 1)
    return F.when(t.rlike(r"^[A-Za-z0-9_-]{20,}$"), t).otherwise(F.nullif(inside, F.lit("")))


def urls(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"""(https?://[^\s"')]+)"""), F.lit(1))


def safe_cell(value: Column) -> Column:
    """A value that a spreadsheet won't read as a formula."""
    t = F.regexp_replace(value, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    return F.when(F.ltrim(t).rlike(r"^[=+\-@]"), F.concat(F.lit("'"), t)).otherwise(t)


def excerpt(text: Column, most: int) -> Column:
    return F.substring(text, 1, most)


def term_lists(texts: pa.Array, stop: frozenset[str]) -> pa.Array:
    """``query_terms`` of a batch."""
    words = re.compile(r"[\wÀ-ÿ]+")
    known: dict[str, str] = {}

    def key(word: str) -> str:
        got = known.get(word)
        if got is None:
            if len(known) >= REMEMBERED:
                known.clear()
            got = known[word] = folded(word)
        return got

    def terms(t: str | None) -> list[str]:
        return [k for k in dict.fromkeys(key(w) for w in words.findall(t or "")) if len(k) >= 2 and k not in stop]

    return few_at_a_time(texts, pa.list_(pa.string()), lambda some: pa.array([terms(t) for t in some.to_pylist()], pa.list_(pa.string())))


def query_terms(text: Column, stop_words: tuple[str, ...] = QUERY_STOP_WORDS) -> Column:
    """Distinct folded words of two characters or more that are no stop words, in order of the text."""
    stop = frozenset(stop_words)

    @F.arrow_udf("array<string>")
    def found(texts: pa.Array) -> pa.Array:
        return term_lists(texts, stop)

    return found(text)


def term_coverage(wanted: Column, held: Column) -> Column:
    """Share of the query's terms (``query_terms``) that the evidence has; 0 without any."""
    q = F.array_distinct(wanted)
    return F.when(F.size(q) > 0, F.size(F.array_intersect(q, held)) / F.size(q)).otherwise(0.0)


def grounding_score(target: Column, evidence: Column, most: int = 60, stop_words: tuple[str, ...] = GROUNDING_STOP_WORDS) -> Column:
    """Shared words of four letters or more over at most ``most`` of the target's; stop words don't count.

    Names that occur in every text, such as the owner's own, belong to ``stop_words``, too.
    """

    def long_words(t):
        found = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(t, F.lit(""))), F.lit(r"([\p{L}]{4,})"), F.lit(1)))
        return F.array_except(found, F.array(*map(F.lit, stop_words)))

    a = long_words(target)
    shared = F.size(F.array_intersect(a, long_words(evidence)))
    return F.least(F.lit(1.0), shared / F.greatest(F.lit(1), F.least(F.size(a), F.lit(most))))


def mission_title(text: Column, fallback: Column) -> Column:
    head = squeeze(F.get(F.split(text, r"[•▪;\n]|(?<=[.!?])\s|(?i)\bphase\b", 2), 0))
    return F.when(F.length(head).between(20, 180), head).otherwise(fallback)


def labelled_lines(facets: dict[str, Column], head: Column, body: Column, per_facet: int = 3, per_value: int = 120, per_line: int = 200, per_head: int = 700, most: int = 1700) -> Column:
    """Retrieval text: a head line, a line of values (bars between them) per non-empty facet, and the trimmed body.

    Head and facet lines together take ``per_head`` characters at most. An empty text, and one of more
    than ``most`` characters, is an error: an encoder would cut it.
    """
    lines = []
    for label, values in facets.items():
        cut = F.transform(F.slice(F.filter(values, lambda v: v.isNotNull() & (v != "")), 1, per_facet), lambda v: F.substring(v, 1, per_value))
        lines.append(F.when(F.size(cut) > 0, F.substring(F.concat(F.lit(f"{label}: "), F.array_join(cut, " | ")), 1, per_line)))
    context = F.regexp_replace(F.substring(F.concat_ws("\n", head, *lines), 1, per_head), r"\s+$", "")
    text = F.regexp_replace(F.concat(context, F.lit("\n"), F.regexp_replace(F.coalesce(body, F.lit("")), r"^\s+|\s+$", "")), r"^\s+|\s+$", "")
    return F.when((F.length(text) > most) | (text == ""), F.raise_error(F.lit("a retrieval text is empty or too long")).cast("string")).otherwise(text)


# The label of each facet in a retrieval text, in order.
CONTEXT_LABELS = {"client": "Client", "country": "Pays", "sector": "Secteur", "offering": "Offre", "service_nature": "Prestation", "project_year": "Année"}


def retrieval_text(file_name: Column, facets: dict[str, Column], body: Column, **bounds) -> Column:
    """The text of a chunk that index, encoder and coverage share: its document's name and facets before it.

    ``facets``: arrays by the names of ``CONTEXT_LABELS``; others are not shown.
    """
    known = {label: facets[name] for name, label in CONTEXT_LABELS.items() if name in facets}
    return labelled_lines(known, F.concat(F.lit("Document: "), file_name), body, **bounds)


def clean_scalar(value: Column, kind: str = "string") -> Column:
    """A cell as text: null empty, booleans in lower case, dates as ISO, whole numbers without a fraction."""
    if kind == "boolean":
        out = F.when(value, "true").otherwise("false")
    elif kind in ("double", "float"):
        out = F.when(value == F.floor(value), F.floor(value).cast("string")).otherwise(value.cast("string"))
    elif kind == "timestamp":
        out = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    elif kind == "date":
        out = F.date_format(value, "yyyy-MM-dd")
    else:
        out = nfkc(value.cast("string"))
    return F.when(value.isNull(), "").otherwise(F.trim(F.regexp_replace(out, r"\s+", " ")))


def citation_label(file_name: Column, page: Column) -> Column:
    return F.concat(file_name, F.lit(" — page "), page.cast("int").cast("string"))


def citation_uri(document_id: Column, page: Column, base: str) -> Column:
    """``base`` names the store, with ``{id}`` where the document's id goes."""
    before, after = base.split("{id}")
    return F.concat(F.lit(before), document_id.cast("string"), F.lit(after), F.lit("#page="), page.cast("int").cast("string"))


def metadata_line(facets: dict[str, Column], per_facet: int = 4, most: int = 1000) -> Column:
    """``Label: v, v | Label: v`` of the facets that have values, cut to ``most`` characters."""
    parts = [F.when(F.size(v) > 0, F.concat(F.lit(f"{label}: "), F.array_join(F.slice(v, 1, per_facet), ", "))) for label, v in facets.items()]
    return F.substring(F.concat_ws(" | ", *parts), 1, most)
