"""Column functions over text. All are built-in expressions; null in, null out unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Section headings by class, English and Spanish, as normalised by `heading`.
SECTIONS = {
    "resumen": ["abstract", "summary", "resumen"],
    "introduccion": ["introduction", "background", "introduccion", "introducción"],
    "metodos": ["methods", "materials and methods", "experimental procedures", "métodos", "metodos"],
    "resultados": ["results", "results and discussion", "resultados"],
    "discusion": ["discussion", "discusion", "discusión"],
    "conclusiones": ["conclusion", "conclusions", "conclusiones"],
    "leyenda": ["fig. legend", "figure legend", "legend", "leyenda"],
    "excluir": ["references", "acknowledgements", "funding", "bibliography"],
}
#: Spellings of signs.
PLUS, MINUS = ["+", "＋", "pos", "(+)", "positive", "activates"], ["-", "–", "−", "(-)", "neg", "negative", "represses"]


def squeeze(c: str | Column) -> Column:
    """White space of any kind collapsed to one blank and cut off at the ends."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), "^ | $", "")


def heading(c: str | Column) -> Column:
    """Heading without numbering, closing marks and case."""
    return F.lower(F.regexp_replace(F.regexp_replace(squeeze(c), r"^(?:\d+(?:\.\d+)*\.?|[IVX]+\.) ", ""), "[.: ]+$", ""))


def section_class(c: str | Column) -> Column:
    """Class of a heading; `otra` for unknown or null ones."""
    name = heading(c)
    out = F.lit("otra")
    for cls, names in SECTIONS.items():
        out = F.when(name.isin(*names), cls).otherwise(out)
    return out


def protein_form(c: str | Column) -> Column:
    """`abcD` as `AbcD`; locus tags and other words stay."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike("^[a-z]{3}[A-Z0-9]"), F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1000))).otherwise(c)


def gene_form(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike("^[A-Z][a-z]{2}[A-Z0-9]"), F.concat(F.lower(F.substring(c, 1, 1)), F.substring(c, 2, 1000))).otherwise(c)


def without_loss_prefix(c: str | Column) -> Column:
    return F.regexp_replace(c, "^(?:[Dd]elta-?|Δ)", "")


def word_groups(words: Column, n: int) -> Column:
    """Hashes of all runs of n words of an array, in order; an array of fewer is one run.

    The words are read once per place of a run, not once per run: a higher-order function would evaluate them again for each.
    """
    shifted = [words, *[F.slice(words, k + 1, F.size(words)) for k in range(1, n)]]
    zipped = F.arrays_zip(*shifted).cast("array<struct<" + ",".join(f"w{k}:string" for k in range(n)) + ">>")
    runs = F.transform(F.filter(zipped, lambda z: z[f"w{n - 1}"].isNotNull()), lambda z: F.xxhash64(F.concat_ws(" ", *[z[f"w{k}"] for k in range(n)])))
    return F.when(F.size(words) < n, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(runs)


def canonical(c: str | Column) -> Column:
    """Text without entity marks, punctuation and case: the key for equal sentences."""
    bare = F.regexp_replace(c, r"(?i)[<\[]\s*/?\s*e[12]\s*[>\]]", " ")
    return squeeze(F.lower(F.regexp_replace(bare, r"(?U)[^\p{L}\p{N}\s]+", " ")))


def locus_range(c: str | Column) -> Column:
    """`PA0425-PA0427` as its loci; a single locus as itself; otherwise empty."""
    c = F.col(c) if isinstance(c, str) else c
    a = F.regexp_extract(c, r"^PA(\d{4})", 1).try_cast("int")
    b = F.coalesce(F.nullif(F.regexp_extract(c, r"^PA\d{4}-(?:PA)?(\d{4})$", 1), F.lit("")).try_cast("int"), a)
    fits = c.rlike(r"^PA\d{4}(?:-(?:PA)?\d{4})?$") & (a <= b)
    return F.when(fits, F.transform(F.sequence(a, b), lambda x: F.concat(F.lit("PA"), F.lpad(x.cast("string"), 4, "0")))).otherwise(F.array().cast("array<string>"))


def article_ids(c: str | Column) -> Column:
    """Article numbers of 7 or 8 digits in a cell, DOIs taken out first, leading zeros dropped, in order, each once.

    A number in scientific notation (`1.2345678E7`) is read as a whole, before runs of digits are.
    """
    bare = F.regexp_replace(c, r"10\.\d{4,}/\S+", " ")

    def number(x: Column) -> Column:
        whole = F.when(x.rlike("[eE]"), x.try_cast("double").try_cast("decimal(38,0)").cast("string")).otherwise(x)
        return F.regexp_replace(whole, "^0+", "")

    found = F.transform(F.regexp_extract_all(bare, F.lit(r"(\d+(?:\.\d+)?[eE]\+?\d{1,2}(?![\w.])|\d+)"), 1), number)
    return F.array_distinct(F.filter(found, lambda x: F.length(x).between(7, 8)))


def sign(c: str | Column) -> Column:
    """`+`, `-` or `?` for any spelling; null stays null."""
    bare = F.lower(F.trim(c))
    return F.when(bare.isNull(), None).when(bare.isin(*PLUS), "+").when(bare.isin(*MINUS), "-").otherwise("?")


def doi(c: str | Column) -> Column:
    """DOI in small letters without resolver or scheme; null if there is none."""
    bare = F.lower(F.regexp_replace(F.trim(c), r"^(?i)(?:https?://(?:dx\.)?doi\.org/|doi:\s*)", ""))
    return F.when(bare.rlike(r"^10\.\d{4,}/"), bare)


#: Words of lost and of raised expression, of a stated sign, and of what only looks like activation.
LOSS = r"(?i)(\b(mutant|mutants|mutation|mutations|knockout|knock-out|deletion|deleted|disrupt|disruption|inactivat|loss of|lacking|null|insertional|defective)|[Dd]elta\s*|Δ|∆)"
RAISED = r"(?i)\b(overexpress|over-express|overproduc|elevated|increased|upregulat|up-regulat|hyperexpress|derepress|de-repress|enhanced expression|higher levels?)"
DIRECT = r"(?i)\b(repress|repressor|negative regulator|negatively regulat|downregulat|down-regulat|silenc|activat|positive regulator|positively regulat|induc|promotes expression|transcriptional regulator|regulon|regulates|regulated by|controls expression|under the control)"
CONTRARY = r"(?i)\b(activat|positive regulator|positively regulat|induc|upregulates|promotes expression)"


def wording(c: str | Column) -> Column:
    """Kind of evidence a sentence words, the first that fits: of a mutant (loss and rise), direct, contrary-looking, other."""
    c = F.col(c) if isinstance(c, str) else c
    mutant = c.rlike(LOSS) & c.rlike(RAISED)
    return F.when(mutant, "fenotipo_mutante").when(c.rlike(DIRECT), "directa").when(c.rlike(CONTRARY), "contraria_aparente").otherwise("otra")


def xml_safe(c: str | Column) -> Column:
    """Without characters that XML 1.0 forbids."""
    return F.regexp_replace(c, r"[^\u0009\u000A\u000D -퟿-�\x{10000}-\x{10FFFF}]", "")


def tsv_cell(c: str | Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[\t\r\n]+", " ")


def redact(c: str | Column) -> Column:
    """File paths and article-like numbers blacked out."""
    return F.regexp_replace(F.regexp_replace(c, r"(?:/[\w.-]+){2,}", "[path]"), r"\b\d{7,9}\b", "[id]")


def locate(text: str, fragment: str) -> Column:
    """0-based place of a literal fragment in a text; null if it is not there."""
    return F.expr(f"nullif(locate({fragment}, {text}) - 1, -1)")


def mark_span(text: str, begin: str | Column, end: str | Column, tag: str) -> Column:
    """The text with `<tag> … </tag>` around the code points [begin, end)."""
    t, b, e = F.col(text), F.col(begin) if isinstance(begin, str) else begin, F.col(end) if isinstance(end, str) else end
    return F.concat(F.substr(t, F.lit(1), b), F.lit(f"<{tag}> "), F.substr(t, b + 1, e - b), F.lit(f" </{tag}>"), F.substr(t, e + 1))


def sentences(c: str | Column) -> Column:
    """Array of sentences: cut after . ! ? and a blank, pieces that end in an abbreviation or initial rejoined."""
    parts = F.split(squeeze(c), r"(?<=[.!?]) ")
    open_end = lambda x: x.rlike(r"(?:^|[ (])(?:[A-Z]|e\.g|i\.e|cf|al|vs|Fig|Figs|Tab|Suppl|approx|Dr|Prof|etc|sp|nov|subsp|pers|comm|No|ca)\.$")
    last = lambda a: F.element_at(a, -1)
    fold = lambda a, x: F.when((F.size(a) > 0) & open_end(last(a)), F.concat(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.array(F.concat_ws(" ", last(a), x)))).otherwise(F.concat(a, F.array(x)))
    return F.when(F.length(squeeze(c)) > 0, F.aggregate(parts, F.array().cast("array<string>"), fold)).otherwise(F.array().cast("array<string>"))


def partial_date(c: str | Column, end: bool = False) -> Column:
    """YYYY, YYYY/MM or YYYY/MM/DD (also with dashes) as a date, the last day of the period with `end`; else null."""
    bare = F.regexp_replace(F.trim(c), "-", "/")
    full = F.when(bare.rlike(r"^\d{4}/\d{1,2}/\d{1,2}$"), F.try_to_date(bare, "yyyy/M/d"))
    month = F.when(bare.rlike(r"^\d{4}/\d{1,2}$"), F.try_to_date(F.concat(bare, F.lit("/1")), "yyyy/M/d"))
    year = F.when(bare.rlike(r"^\d{4}$"), F.try_to_date(F.concat(bare, F.lit("/12/1" if end else "/1/1")), "yyyy/M/d"))
    return F.coalesce(full, F.last_day(month) if end else month, F.last_day(year) if end else year)


def short_hash(*cols: str, digits: int = 16) -> Column:
    """First digits of the SHA-1 of the columns joined by |; nulls count as empty."""
    return F.substring(F.sha1(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])), 1, digits)


#: Ligatures and look-alike hyphens of typeset text.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "‐": "-", "‑": "-", "−": "-", "­": ""}


def without_ligatures(c: str | Column) -> Column:
    """Typeset characters as plain ones."""
    out = F.col(c) if isinstance(c, str) else c
    for a, b in LIGATURES.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def like_pattern(text: str) -> str:
    """A LIKE pattern (escape character \\) that finds the text anywhere, its own wildcards taken literally."""
    return "%" + text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"


def alias_chains(c: str | Column) -> Column:
    """`a = b (= c); d = e` as arrays of names that mean the same: [[a, b, c], [d, e]]."""
    plain = F.regexp_replace(c, r"[()]", " ")
    names = lambda x: F.filter(F.transform(F.split(x, "[=≡]"), lambda y: F.trim(y)), lambda y: y != "")
    return F.filter(F.transform(F.split(plain, ";"), names), lambda x: F.size(x) > 1)
