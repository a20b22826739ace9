"""State dimension for F8: name, abbreviation, FIPS code or near spelling -> code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# US states, the federal district and the inhabited territories
# as (abbreviation, name, FIPS code).
STATES = (
    ("AL", "Alabama", "01"), ("AK", "Alaska", "02"), ("AZ", "Arizona", "04"),
    ("AR", "Arkansas", "05"), ("CA", "California", "06"), ("CO", "Colorado", "08"),
    ("CT", "Connecticut", "09"), ("DE", "Delaware", "10"), ("DC", "District of Columbia", "11"),
    ("FL", "Florida", "12"), ("GA", "Georgia", "13"), ("HI", "Hawaii", "15"),
    ("ID", "Idaho", "16"), ("IL", "Illinois", "17"), ("IN", "Indiana", "18"),
    ("IA", "Iowa", "19"), ("KS", "Kansas", "20"), ("KY", "Kentucky", "21"),
    ("LA", "Louisiana", "22"), ("ME", "Maine", "23"), ("MD", "Maryland", "24"),
    ("MA", "Massachusetts", "25"), ("MI", "Michigan", "26"), ("MN", "Minnesota", "27"),
    ("MS", "Mississippi", "28"), ("MO", "Missouri", "29"), ("MT", "Montana", "30"),
    ("NE", "Nebraska", "31"), ("NV", "Nevada", "32"), ("NH", "New Hampshire", "33"),
    ("NJ", "New Jersey", "34"), ("NM", "New Mexico", "35"), ("NY", "New York", "36"),
    ("NC", "North Carolina", "37"), ("ND", "North Dakota", "38"), ("OH", "Ohio", "39"),
    ("OK", "Oklahoma", "40"), ("OR", "Oregon", "41"), ("PA", "Pennsylvania", "42"),
    ("RI", "Rhode Island", "44"), ("SC", "South Carolina", "45"), ("SD", "South Dakota", "46"),
    ("TN", "Tennessee", "47"), ("TX", "Texas", "48"), ("UT", "Utah", "49"),
    ("VT", "Vermont", "50"), ("VA", "Virginia", "51"), ("WA", "Washington", "53"),
    ("WV", "West Virginia", "54"), ("WI", "Wisconsin", "55"), ("WY", "Wyoming", "56"),
    ("AS", "American Samoa", "60"), ("GU", "Guam", "66"), ("MP", "Northern Mariana Islands", "69"),
    ("PR", "Puerto Rico", "72"), ("VI", "Virgin Islands", "78"),
)


def _map(pairs) -> Column:
    from trueform.functions.cells import _literal_map
    return _literal_map(list(pairs))


def state_code(x: Column) -> Column:
    """Exact abbreviation, FIPS code or name first; else the one name nearest in spelling."""
    norm = F.upper(F.regexp_replace(F.btrim(x), r"\s+", " "))
    by_abbr = _map((a, a) for a, _, _ in STATES)
    by_fips = _map((f, a) for a, _, f in STATES)
    by_name = _map((n.upper(), a) for a, n, _ in STATES)
    fips_key = F.lpad(norm, 2, "0")
    exact = F.coalesce(
        F.when(norm.rlike(r"^[A-Z]{2}$"), F.try_element_at(by_abbr, norm)),
        F.when(norm.rlike(r"^\d{1,2}$"), F.try_element_at(by_fips, fips_key)),
        F.try_element_at(by_name, norm),
    )
    return F.coalesce(exact, F.when(~norm.rlike(r"^[A-Z]{0,2}$|^\d+$"), _nearest(norm)))


def _nearest(norm: Column) -> Column:
    """The one state whose name is nearest and near: one edit for words up to five letters, else two.

    One pass over the names whose length lies within two of the cell's.
    """
    by_length: dict[int, list[str]] = {}
    for a, n, _ in STATES:
        for length in range(len(n) - 2, len(n) + 3):
            by_length.setdefault(length, []).append(f"struct('{n.upper()}' AS name, '{a}' AS code)")
    names = F.expr("map(" + ", ".join(f"{n}, array({', '.join(v)})" for n, v in by_length.items()) + ")")
    limit = F.when(F.length(norm) <= 5, 1).otherwise(2)
    # distances of the near names only; the fold keeps the least one, its code and how many names share it
    near = F.filter(F.try_element_at(names, F.length(norm)), lambda s: F.levenshtein(norm, s["name"], 2) >= 0)
    far = F.transform(near, lambda s: F.struct(F.levenshtein(norm, s["name"], 2).alias("d"), s["code"].alias("code")))
    start = F.struct(limit.alias("d"), F.lit(None).cast("string").alias("code"), F.lit(0).alias("n"))

    def closer(acc, s):
        first = (s["d"] < acc["d"]) | ((s["d"] == acc["d"]) & (acc["n"] == 0))
        again = (s["d"] == acc["d"]) & (acc["n"] > 0)
        return (F.when(first, F.struct(s["d"].alias("d"), s["code"].alias("code"), F.lit(1).alias("n")))
                .when(again, F.struct(acc["d"].alias("d"), acc["code"].alias("code"), (acc["n"] + 1).alias("n")))
                .otherwise(acc))

    return F.aggregate(far, start, closer, lambda acc: F.when(acc["n"] == 1, acc["code"]))
