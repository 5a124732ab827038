"""Fill-in-the-middle: a text is cut at two of its lines, and the part between them moves to the end.

One match of ``(unit)*`` over the whole text keeps every repetition of its group. The number of their
ends is the number of lines, and the two cuts are two of these ends. Where to cut, whether to cut and
which form to write are taken from a hash of the document's id, so a task that runs again, or another
engine, gets the same rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.llm.rows import table

#: A line with its end, or a last line without one. What a group has taken, it does not give back.
LINE = r"[^\n]*+\n|[^\n]++"
PLAIN, PSM, SPM = "plain", "psm", "spm"
_RESULT = "struct<n:long,form:string,prefix_chars:long,middle_chars:long,output:string>"


@dataclass(frozen=True)
class Recipe:
    """How texts are cut: the salt of the hash, shares in percent, and the three markers."""

    seed: int = 7
    #: Texts out of a hundred that are transformed, and how many of those begin with the suffix.
    rate: int = 100
    suffix_first: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    unit: str = LINE

    def __post_init__(self) -> None:
        # A marker is found again only if none can begin inside another, or inside a part's end.
        for one in self.markers:
            if not one:
                raise ValueError("a marker is empty")
            for two in self.markers:
                inside = one is not two and one in two
                if inside or any(one.endswith(two[:i]) for i in range(1, len(two))):
                    raise ValueError(f"the markers {one!r} and {two!r} overlap")

    @property
    def markers(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle

    def draws(self, key: int | None) -> tuple[int, int, int, int]:
        """Four numbers for a document; a NULL id counts as an empty one."""
        name = f"{self.seed}:{'' if key is None else key}"
        digest = hashlib.sha256(name.encode()).hexdigest()
        return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


def transformed(
    text: str | None, key: int | None, recipe: Recipe, units: regex.Pattern
) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, characters of the prefix, of the middle, output) of one text."""
    text = text or ""
    match = units.fullmatch(text)
    ends = match.ends(1) if match else []
    one, two, whether, which = recipe.draws(key)
    plain = not ends or whether % 100 >= recipe.rate or any(m in text for m in recipe.markers)
    if plain:
        return len(ends), PLAIN, None, None, text
    first, second = sorted((one % (len(ends) + 1), two % (len(ends) + 1)))
    start, end = (ends[cut - 1] if cut else 0 for cut in (first, second))
    before, middle, after = text[:start], text[start:end], text[end:]
    parts = [recipe.prefix + before, recipe.suffix + after]
    form = PSM
    if which % 100 < recipe.suffix_first:
        form = SPM
        parts.reverse()
    return len(ends), form, start, end - start, "".join([*parts, recipe.middle, middle])


def fill_in_middle(
    docs: DataFrame, recipe: Recipe = Recipe(), text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Per row: ``doc_id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``n`` counts the units of the text, whatever its form. Plain, and so unchanged, are texts that are
    NULL or empty, hold a marker, are not made of units, or are not drawn. Lengths count code points
    and are NULL for plain texts. Repeated rows get equal results; other columns are not read. Ids are
    whole numbers or NULL. A task holds one Arrow batch, and a number for each unit of one text.
    """

    @F.arrow_udf(_RESULT)
    def cut(texts: pa.Array, keys: pa.Array) -> pa.Array:
        units = regex.compile(f"({recipe.unit})*+", regex.VERSION1)
        rows = zip(texts.to_pylist(), keys.to_pylist(), strict=True)
        found = [transformed(t, k, recipe, units) for t, k in rows]
        columns = zip(*found, strict=True) if found else [[]] * 5
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["n", "form", "prefix_chars", "middle_chars", "output"],
        )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.select("doc_id", cut("text", "doc_id").alias("cut")).select("doc_id", "cut.*")


def restored(output: Column, form: Column, recipe: Recipe = Recipe()) -> Column:
    """The text from which ``output`` was made, from nothing but the output and its form.

    Each marker occurs once in an output that is not plain, so what lies around it is what was joined.
    """

    def between(left: str, right: str) -> Column:
        return F.substring_index(F.substring_index(output, left, -1), right, 1)

    after = F.substring_index(output, recipe.middle, -1)
    psm = F.concat(
        between(recipe.prefix, recipe.suffix), after, between(recipe.suffix, recipe.middle)
    )
    spm = F.concat(
        between(recipe.prefix, recipe.middle), after, between(recipe.suffix, recipe.prefix)
    )
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return fill_in_middle(docs).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP11_SQL = r"""
with hashed as (
    select doc_id, coalesce(text, '') as t,
           sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h
    from documents
),
lines as (
    select doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') as units,
           cast('0x' || substr(h, 1, 8) as bigint) as h1,
           cast('0x' || substr(h, 9, 8) as bigint) as h2,
           cast('0x' || substr(h, 25, 8) as bigint) as h4
    from hashed
),
cuts as (
    select *, len(units) as n,
           least(h1 % (len(units) + 1), h2 % (len(units) + 1)) as a,
           greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) as b,
           case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
                then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form
    from lines
),
parts as (
    select *, coalesce(array_to_string(units[1:a], ''), '') as prefix,
           coalesce(array_to_string(units[a + 1:b], ''), '') as middle,
           coalesce(array_to_string(units[b + 1:n], ''), '') as suffix
    from cuts
)
select doc_id, n, form,
       case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then t
                        when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end)
           as output_sha256,
       sha256(t) as restored_sha256
from parts
"""
