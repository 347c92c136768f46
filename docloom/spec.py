"""Description of one site: where its rows come from and what becomes of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Source:
    """A named source.

    ``kind`` is ``"jdbc"`` (``options``: url, driver, user, password, ...),
    ``"files"`` (``tables``: table name to path, ``options``: reader options and
    ``format``) or ``"catalog"`` (tables and views of the session).
    """

    name: str
    kind: str = "catalog"
    options: Mapping[str, str] = field(default_factory=dict)
    tables: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Extract:
    """One staging table: ``query`` runs on ``source`` and is staged as ``name``.

    ``key`` is a numeric column of the query's result used to split the read,
    with ``parts`` into that many ranges of equal row count. ``buckets`` lays the
    staged rows out by the hash of ``bucket_by`` for joins without a shuffle.
    ``transform`` is applied to the staged rows, e.g. a fold or an ancestor
    closure, and replaces them; the source is read once.
    """

    name: str
    query: str
    source: str | None = None
    key: str | None = None
    transform: Callable[[DataFrame], DataFrame] | None = None
    parts: int = 0
    buckets: int = 0
    bucket_by: Sequence[str] = ()


@dataclass(frozen=True)
class Assembly:
    """One assembly statement over the staging tables.

    ``kind="documents"`` feeds the new version; ``kind="table"`` makes a helper
    table ``name`` that later statements can read. ``query`` is Spark SQL, or a
    function of the session, for steps of the DataFrame API.

    The other kinds change the staging table ``name``: ``"insert"`` adds the
    rows of ``query``, ``"delete"`` and ``"update"`` take ``where``, and ``"merge"`` merges the rows
    of ``query`` by the columns ``on``. ``values`` maps columns to SQL expressions.
    """

    name: str
    query: str | Callable[[SparkSession], DataFrame] = ""
    kind: str = "documents"
    where: str = "true"
    values: Mapping[str, str] | None = None
    on: Sequence[str] = ()
    delete_where: str | None = None


@dataclass(frozen=True)
class PipelineSpec:
    """A site. Extracts run side by side, assemblies in the order given."""

    site: str
    sources: Sequence[Source]
    extracts: Sequence[Extract]
    assemblies: Sequence[Assembly]
    id_key: str
    index_name: str
    database: str
    default_source: str | None = None
    alias: str | None = None
    lang: str = ""
    host: str = ""
    time_zone: str | None = None
    doc_type: str = "_doc"
    import_limit: int = 0
    schema_mode: str = "native"
    # Text columns with JSON arrays to decode: column -> array type.
    json_fields: Mapping[str, str] = field(default_factory=dict)
    # Metadata array column and the keys to promote: key -> document field.
    meta_field: str | None = None
    promoted: Mapping[str, str] = field(default_factory=dict)
    # Part numbers of folded columns, see docloom.operators.parts.
    part_columns: Sequence[str] = ()
    # Order of documents with one id; ties are broken by statement and content.
    order: Sequence[str] = ()
    mapping: Mapping | None = None
    min_success: int = 80

    @property
    def alias_name(self) -> str:
        return self.alias or self.index_name

    @property
    def prefix(self) -> str:
        return f"{self.index_name}_"

    @property
    def params(self) -> dict[str, str]:
        return {"lang": self.lang, "site": self.site, "host": self.host}

    def source(self, name: str | None) -> Source:
        wanted = name or self.default_source or self.sources[0].name
        for source in self.sources:
            if source.name == wanted:
                return source
        raise KeyError(f"no source {wanted!r} in site {self.site!r}")


def render(text: str, params: Mapping[str, str]) -> str:
    """``{name}`` placeholders of the given parameters replaced, all else untouched.

    For settings, mappings and the extract SQL of remote databases; SQL that
    Spark runs itself can use named parameters (``:lang``) instead.
    """
    for name, value in params.items():
        text = text.replace("{" + name + "}", value)
    return text
