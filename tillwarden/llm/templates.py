"""Benchmark decontamination by template canonicalisation.

Texts are read as lower-cased words, of which some stand for a typed slot:

    number   a word that begins with a digit; 3.5 and 1,200 are one word
    unit     a unit of measure or currency
    name     a capitalised word

Whether a word that opens a sentence is a name cannot be seen, so there are two template forms: INNER, in
which only capitalised words within a sentence are names, and ANY, in which all are.  Windows of
``window`` words and slots are hashed in each form on both sides and joined.  A re-parameterised
copy (other numbers, names and units) has the same windows; whether it is a copy shows in its slots:
over all windows of a form that a place of a document shares with an item, a name or unit of the item must
stand for one of the document (one ``anna`` cannot be both ``maria`` and ``eva``).  Windows that hold such a
torn value do not count, unless all their names and units are the item's own; all others do.  Numbers are
independent: two 3s of an item may become 5 and 2.

A template with more slots than plain words would match tables of figures and lists of names.  Windows
of that kind are compared by their words in the third form, LITERAL.  A document leaks an item if its windows
make up ``percent`` of the item's, or those with a template ``percent`` of the item's windows with
one, since in a re-parameterised copy no literal window can match.  A window counts once, whatever the number
of its forms.  Items shorter than a window are one window of their own length.

All is column expressions.  First pass: every text's windows as 64-bit hashes, exploded and joined
with the benchmark's, which gives the documents with any match.  Second pass over those
only: windows with their words, compared in full and grouped by document, item, form and offset,
a group that the item's length bounds.  Literal hashes are worked out only for sizes of which the
benchmark has literal windows.  The benchmark's windows and the ids of matching documents
are broadcast while they are at most MAX_BROADCAST rows; beyond that the joins shuffle.

Cases: a null or wordless text has no windows; null ids take no part; rows of one id are one document
or item; repeated rows change nothing; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwarden.llm.shared import texts, written

# Fixed list: units and currencies that stand for one another.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l gal s sec min h hr hrs ms "
    "day days week weeks month months year years hour hours minute minutes second seconds "
    "meter meters metre metres kilometer kilometers kilometre kilometres mile miles foot feet inch inches "
    "gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres "
    "percent dollar dollars euro euros cent cents usd eur gbp kmh mph"
).split()

WINDOW = 8
PERCENT = 30
MAX_BROADCAST = 200_000

INNER, ANY, LITERAL = 0, 1, 2

NAME_MARK, OPENER_MARK = "\x01", "\x02"
# ASCII marks and white space but "_", and the blocks of general and CJK punctuation
SEPARATOR = r"\x03-/:-@\[-^`{-\x7f\xa0 -⁯　-〿"
SEPARATORS = rf"[{SEPARATOR}]+"
BEFORE_NAME = r"(?=\p{Lu})(?<=[^.!?\s]\s{1,9})(?=\p{Lu}\p{Ll})"
BEFORE_OPENER = rf"(?=\p{{Lu}}\p{{Ll}})(?<![^{SEPARATOR}])"  # the names have their mark before them by then
IN_NUMBER = r"(?<=[0-9])[.,](?=[0-9])"
SLOTS = {"number": 1, "unit": 2, "name": 3}  # no word's hash is that small in practice; words are compared later


def words_of(text: Column) -> Column:
    """Lower-cased words; a name begins with NAME_MARK, any other capitalised word with OPENER_MARK, marks
    within a number become "_"."""
    plain = F.regexp_replace(text, f"[{NAME_MARK}{OPENER_MARK}]", " ")
    plain = F.when(plain.rlike("[0-9][.,][0-9]"), F.regexp_replace(plain, IN_NUMBER, "_")).otherwise(plain)
    marked = F.regexp_replace(F.regexp_replace(plain, BEFORE_NAME, NAME_MARK), BEFORE_OPENER, OPENER_MARK)
    return F.array_remove(F.split(F.lower(marked), SEPARATORS, -1), "")


def _bare(word: Column) -> Column:
    return F.when(word < "0", F.substring(word, 2, 1 << 30)).otherwise(word)


def _in_form(word: Column, form: int) -> Column:
    """The word as the form reads it: only names have a mark, and all have the same."""
    if form == LITERAL:
        return _bare(word)
    if form == INNER:
        return F.when((word < "0") & (word >= OPENER_MARK), F.substring(word, 2, 1 << 30)).otherwise(word)
    return F.when(word < "0", F.concat(F.lit(NAME_MARK), F.substring(word, 2, 1 << 30))).otherwise(word)


def _read(form: int) -> Column:
    return F.transform("words", lambda w: _in_form(w, form))


def _slot(word: Column) -> Column:
    """The hash of a word in its form, or the small number of its slot's type.

    Digits sort before letters and the mark before digits, so two comparisons tell the types.
    """
    return (
        F.when(word < "0", F.lit(SLOTS["name"]).cast("long"))
        .when(word < ":", F.lit(SLOTS["number"]).cast("long"))
        .when(word.isin(UNITS), F.lit(SLOTS["unit"]).cast("long"))
        .otherwise(F.xxhash64(word))
    )


def _worded(rows: DataFrame, key: str) -> DataFrame:
    """Words of every text and their hashes in each form, as columns of their own so that they are worked out
    once; ``slots_2`` is used where literal windows are wanted."""
    worded = rows.select(key, words_of(F.col("text")).alias("words"))
    worded = worded.withColumn("slots_0", F.transform("words", lambda w: _slot(_in_form(w, INNER))))
    name = F.lit(SLOTS["name"]).cast("long")
    return worded.withColumns(
        {
            "slots_1": F.zip_with("words", "slots_0", lambda w, s: F.when(w < "0", name).otherwise(s)),
            "slots_2": F.transform("words", lambda w: F.xxhash64(_bare(w))),
        }
    )


def _with_windows(worded: DataFrame, sizes: dict[int, list[int]]) -> DataFrame:
    """Adds ``windows_<form>_<size>``: hashes of all windows of each form's sizes, empty for shorter texts.

    Longer windows are pairs of shorter ones: 8 = 4 + 4, 5 = 4 + 1.  Each length is a step of
    its own, since it is used twice by the next one.
    """
    df = worded
    for form in sizes:
        made = {1: f"slots_{form}"}

        def add(size: int, left: int) -> None:
            nonlocal df
            right = size - left
            shifted = F.slice(F.col(made[right]), F.lit(left + 1), F.greatest(F.size("words") - left, F.lit(0)))
            pairs = F.zip_with(made[left], shifted, lambda x, y: F.xxhash64(x, y))
            whole = F.slice(pairs, F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(0)))
            df = df.withColumn(f"windows_{form}_{size}", whole)
            made[size] = f"windows_{form}_{size}"

        def need(size: int) -> None:
            if size not in made:
                left = 1 << (size - 1).bit_length() - 1
                need(left)
                need(size - left)
                add(size, left)

        for size in sizes[form]:
            need(size)
        df = df.withColumn(f"windows_{form}_1", F.col(f"slots_{form}"))
    return df


def _with_words(rows: DataFrame, key: str, sizes: dict[int, list[int]], own_size: int | None = None) -> DataFrame:
    """One row per window and form: hash, place and words as the form reads them.  ``own_size``: windows of that
    size, or of the whole text where it is shorter, and their words in the two template forms.

    The texts' words are read before the explode: after it only a slice of them is taken, in generated code,
    which buffers all rows of a text and must not hold a copy of the whole text in each.
    """
    worded = _with_windows(_worded(rows, key), sizes).withColumn("n", F.size("words"))
    wide = (INNER, ANY) if own_size is not None else ()
    parts = []
    for form in sizes:
        read = {f: _read(f) for f in {form, *wide}}
        in_form = worded.withColumns({f"read_{f}": words for f, words in read.items()})
        for size in sizes[form]:
            # outer: the filter that an inner explode implies would work out the windows once more
            wanted = in_form if own_size is None else in_form.filter(F.least("n", F.lit(own_size)) == size)
            arrays = [f"read_{f}" for f in sorted(read)]
            placed = wanted.select(key, *arrays, F.posexplode_outer(f"windows_{form}_{size}").alias("place", "hash"))
            placed = placed.filter("hash is not null")
            part = {f: F.slice(f"read_{f}", F.col("place") + 1, F.lit(size)) for f in read}
            parts.append(
                placed.select(
                    key, "place", F.lit(form).alias("form"), F.lit(size).alias("size"), "hash",
                    part[form].alias("part"), *(part[f].alias(f"part_{f}") for f in wide),
                )
            )
    return reduce(DataFrame.union, parts)


def _is_slot(word: Column) -> Column:
    return (word < ":") | word.isin(UNITS)


def _must_agree(word: Column) -> Column:
    """Names and units; numbers are independent, since equal ones may count different things."""
    return (word < "0") | word.isin(UNITS)


def _bounded_broadcast(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MAX_BROADCAST else df


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = PERCENT) -> DataFrame:
    """doc_id, item_id, n_windows, item_windows: documents that hold a benchmark item, and how much of it."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).filter("item_id is not null and text is not null")
    lengths = items.select(F.least(F.size(words_of(F.col("text"))), F.lit(window)).alias("n")).distinct().collect()
    own = sorted(r.n for r in lengths if r.n) or [window]
    item_windows = _with_words(items, "item_id", dict.fromkeys((INNER, ANY, LITERAL), own), window)
    item_windows = written(item_windows.distinct(), "item-windows")
    heavy = {f: F.size(F.filter(f"part_{f}", lambda w: ~_is_slot(w))) * 2 < F.col("size") for f in (INNER, ANY)}
    # a window that is no template in the wider form is compared by its words too
    item_windows = item_windows.filter(
        F.when(F.col("form") == INNER, ~heavy[INNER]).otherwise(heavy[ANY] == (F.col("form") == LITERAL))
    )
    item_windows = item_windows.withColumn("heavy", heavy[INNER]).drop(f"part_{INNER}", f"part_{ANY}")
    sizes: dict[int, list[int]] = {}  # at most `window` of each form
    for form, size in sorted(map(tuple, item_windows.select("form", "size").distinct().collect())):
        sizes.setdefault(form, []).append(size)
    sizes = sizes or {INNER: [window]}

    wanted = _bounded_broadcast(item_windows.select("hash").distinct())
    source = texts(docs).filter("doc_id is not null")
    hashed = _with_windows(_worded(source, "doc_id"), sizes)
    windows = [F.col(f"windows_{f}_{s}") for f in sizes for s in sizes[f]]
    hashed = hashed.select("doc_id", F.explode_outer(F.concat(*windows) if len(windows) > 1 else windows[0]).alias("hash"))
    touched = written(hashed.join(wanted, "hash", "left_semi").select("doc_id").distinct(), "touched")

    again = source.join(_bounded_broadcast(touched), "doc_id", "left_semi")
    mine = _with_words(again, "doc_id", sizes).withColumnsRenamed({"part": "doc_part", "place": "doc_place"})
    theirs = item_windows.select("hash", "form", "size", "item_id", "part", "place", "heavy")
    alike = F.forall(
        F.zip_with("doc_part", "part", lambda d, i: (_slot(d) == _slot(i)) & (_is_slot(d) == _is_slot(i))), lambda x: x
    )
    same = F.when(F.col("form") == LITERAL, F.col("doc_part") == F.col("part")).otherwise(alike)
    matched = mine.join(_bounded_broadcast(theirs), ["hash", "form", "size"]).filter(same)
    values = F.filter(
        F.zip_with("part", "doc_part", lambda i, d: F.when(_must_agree(i), F.struct(i.alias("item"), d.alias("doc")))),
        lambda v: v.isNotNull(),
    )
    places = matched.select(
        "doc_id", "item_id", "form", (F.col("doc_place") - F.col("place")).alias("offset"),
        F.struct("place", "heavy", values.alias("values")).alias("window"),
    )
    groups = places.groupBy("doc_id", "item_id", "form", "offset").agg(F.collect_set("window").alias("windows"))
    pairs = F.array_distinct(F.flatten(F.transform("windows", lambda w: w["values"])))
    stands_for = F.array_sort(F.transform(pairs, lambda v: v["item"]))
    # item values that stand for more than one document value; arrays of one element work an expression out once
    torn = F.transform(F.array(stands_for), lambda s: F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1))))[0]
    whole = F.transform(
        F.array(torn),
        lambda t: F.filter(
            "windows",
            lambda w: F.forall(w["values"], lambda v: ~F.array_contains(t, v["item"]))
            | F.forall(w["values"], lambda v: v["item"] == v["doc"]),
        ),
    )[0]
    light = F.count_distinct(F.when(~F.col("heavy"), F.col("place")))
    found = (
        groups.select("doc_id", "item_id", F.explode(whole).alias("w"))
        .select("doc_id", "item_id", "w.place", "w.heavy")
        .groupBy("doc_id", "item_id")
        .agg(F.count_distinct("place").alias("n_windows"), light.alias("n_light"))
    )
    sizes_of_items = item_windows.groupBy("item_id").agg(
        F.count_distinct("place").alias("item_windows"), light.alias("item_light")
    )
    enough = (F.col("n_windows") * 100 >= F.col("item_windows") * percent) | (
        (F.col("item_light") > 0) & (F.col("n_light") * 100 >= F.col("item_light") * percent)
    )
    return found.join(sizes_of_items, "item_id").filter(enough).select("doc_id", "item_id", "n_windows", "item_windows")
