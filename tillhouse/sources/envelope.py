"""Unwrapping response pages into documents.

A page is a list of documents, or an object that holds the list. Both become one
object with a `data` list, so each page is parsed once against a fixed schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from tillhouse.functions.menus import member
from tillhouse.functions.values import filled

_CORRUPT = "_corrupt"
# In every object with numbers or flags: which of them did not fit, null when all do.
UNFIT = "_unfit"


def _clean(page: Column) -> Column:
    """A page without the white space of JSON and a byte order mark around it.

    Trimming walks over the whole text; a page with brackets at both ends has nothing to trim.
    """
    bare = (page.startswith("[") | page.startswith("{")) & (page.endswith("]") | page.endswith("}"))
    return F.when(bare, page).otherwise(F.btrim(page, F.lit(" \t\r\n\ufeff")))


def _is_list(page: Column) -> Column:
    return _clean(page).startswith("[")


def _is_text_able(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DoubleType, T.BooleanType))


def _with_unfit(kind: T.DataType) -> T.DataType:
    """The type with an `_unfit` field in each object that has numbers or flags."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_with_unfit(kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [T.StructField(f.name, _with_unfit(f.dataType)) for f in kind]
        if any(_is_text_able(f.dataType) for f in kind):
            fields.append(T.StructField(UNFIT, T.StringType()))
        return T.StructType(fields)
    return kind


def _as_text(kind: T.DataType) -> T.DataType:
    """The type with numbers and flags as text."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind])
    return T.StringType() if _is_text_able(kind) else kind


def _fit(text: Column, kind: T.DataType) -> Column:
    """A value read as `_as_text(kind)`, as `_with_unfit(kind)`."""
    if isinstance(kind, T.ArrayType):
        return F.transform(text, lambda element: _fit(element, kind.elementType))
    if isinstance(kind, T.StructType):
        values = [_fit(text[f.name], f.dataType).alias(f.name) for f in kind]
        unfit = [
            F.when(filled(text[f.name]) & (text[f.name] != "false") & value.isNull(), F.lit(f"bad {f.name}"))
            for f, value in zip(kind, values)
            if _is_text_able(f.dataType)
        ]
        if unfit:
            values.append(F.nullif(F.concat_ws(", ", *unfit), F.lit("")).alias(UNFIT))
        return F.when(text.isNotNull(), F.struct(*values))
    return text.try_cast(kind) if _is_text_able(kind) else text


def _page_of(document: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField("data", T.ArrayType(document)), T.StructField(_CORRUPT, T.StringType())]
    )


def narrowed(document: str, used: list[str]) -> T.StructType:
    """The document's type without the text, numbers and flags that are not used, which are named by their paths.

    Objects, lists and variants stay, so that the same pages are unreadable.
    """

    def kept(kind: T.DataType, place: str) -> T.DataType:
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(kept(kind.elementType, place))
        if not isinstance(kind, T.StructType):
            return kind
        leaf = (T.StringType, T.DoubleType, T.BooleanType)
        fields = [f for f in kind if not isinstance(f.dataType, leaf) or place + f.name in used]
        return T.StructType([T.StructField(f.name, kept(f.dataType, f"{place}{f.name}.")) for f in fields])

    return kept(T.StructType.fromDDL(document), "")


def parse_pages(pages: DataFrame, document: str | T.StructType) -> DataFrame:
    """Adds `data`, the documents of a page, and `page_error`.

    A page is parsed once, straight to its types. Only a page with a value that does
    not fit is read again with numbers and flags as text, so that the values that do
    fit are kept and the others noted in `_unfit`. A page that is no JSON, or has a
    list or object where another kind belongs, is an error as a whole: none of its
    documents is half read. So is a page with nothing on it.
    """
    kind = T.StructType.fromDDL(document) if isinstance(document, str) else document
    options = {"columnNameOfCorruptRecord": _CORRUPT}
    page = _clean(F.col("value"))
    whole, typed, text = F.col("_whole"), F.col("_typed"), F.col("_text")
    # A column of its own, since what stands inside `from_json` is not compiled.
    listed = F.when(page.startswith("["), F.concat(F.lit('{"data":'), page, F.lit("}"))).otherwise(page)
    parsed = pages.withColumn("_whole", listed).withColumn("_typed", F.from_json(whole, _page_of(_with_unfit(kind)), options)).withColumn(
        "_text", F.when(typed[_CORRUPT].isNotNull(), F.from_json(whole, _page_of(_as_text(kind)), options))
    )
    data = F.when(typed[_CORRUPT].isNull(), typed["data"]).when(
        text[_CORRUPT].isNull(), _fit(text["data"], T.ArrayType(kind))
    )
    return parsed.select(
        *pages.columns,
        data.alias("data"),
        F.when(text[_CORRUPT].isNotNull() | (whole == ""), F.lit("unreadable page")).alias("page_error"),
    )


def documents(parsed: DataFrame) -> DataFrame:
    """One row per document of the readable pages; page columns are kept."""
    # The error test is part of the list: as a filter, or with the bare column, it
    # would be pushed below the parsing and parse every page a second time.
    readable = F.when(F.col("page_error").isNull(), F.col("data"))
    carried = [c for c in parsed.columns if c not in ("value", "data", "page_error")]
    return parsed.select(*carried, F.explode(readable).alias("doc"))


def documents_and_pages(parsed: DataFrame) -> DataFrame:
    """One row per document, and one without per page that cannot be read.

    `doc_no` is the document's place on its page, null for such a page, which keeps its `value` and
    `page_error`. A page without documents gives no row.
    """
    broken = F.col("page_error").isNotNull()
    carried = [c for c in parsed.columns if c not in ("value", "data")]
    listed = parsed.select(
        *carried,
        F.when(broken, F.col("value")).alias("value"),
        F.posexplode_outer(F.when(~broken, F.col("data"))).alias("doc_no", "doc"),
    )
    return listed.where(F.col("doc_no").isNotNull() | F.col("page_error").isNotNull())


def broken_pages(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("page_error").isNotNull())


def first_documents(pages: DataFrame, document: str) -> DataFrame:
    """Parsed pages with their first document only; an object page is the document.

    An empty document counts as none.
    """
    page = _clean(F.col("value"))
    first = F.concat(F.lit("["), F.get_json_object(page, "$[0]"), F.lit("]"))
    listed = F.when(_is_list(page), F.coalesce(first, page)).otherwise(F.concat(F.lit("["), page, F.lit("]")))
    listed = F.when(page == "", page).otherwise(listed)
    empty = F.regexp_replace("value", r"\s", "") == "[{}]"
    one = pages.withColumn("value", listed).withColumn("value", F.when(empty, F.lit("[]")).otherwise(F.col("value")))
    parsed = parse_pages(one, document)
    return parsed.withColumn("data", F.filter(F.slice("data", 1, 1), lambda doc: doc.isNotNull()))


def first_per_restaurant(docs: DataFrame) -> DataFrame:
    """The document of each restaurant's first page, by file name.

    Pages that cannot be read, where `docs` has them, all stay.
    """
    least = F.min_by(F.struct(*docs.columns), F.struct("source_file", F.to_json("doc")))
    keys = [F.col("restaurant_guid")]
    if "page_error" in docs.columns:
        keys.append(F.when(F.col("page_error").isNotNull(), F.struct("source_file", "value")))
    return docs.groupBy(*keys).agg(least.alias("first")).select("first.*")


def menu_pages(pages: DataFrame) -> DataFrame:
    """Adds `menus`, the list of menus of a page as variants, and `page_error`.

    A list page is the list itself. An object page gives its `menus`, else its
    `data`, else the object as the only menu; a key that is there decides, even
    when its value is null.
    """
    read = pages.withColumn("_page", F.try_parse_json(_clean(F.col("value"))))
    page = F.col("_page")
    wrapped = F.coalesce(member(page, "menus", "variant"), member(page, "data", "variant"))
    menus = (
        F.when(_is_list(F.col("value")), page.try_cast("array<variant>"))
        .when(wrapped.isNotNull(), wrapped.try_cast("array<variant>"))
        .otherwise(F.array(page))
    )
    return read.select(
        *pages.columns,
        menus.alias("menus"),
        F.when(page.isNull() & F.col("value").isNotNull(), F.lit("unreadable page")).alias("page_error"),
    )
