"""Documents to quads, and questions asked of quads."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import count, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from metaloom.functions import terms
from metaloom.functions.bind import shuffled
from metaloom.operators import labelling
from metaloom.operators.components import components
from metaloom.session import cut_lineage, removed, written, written_alone, written_and_measured
from metaloom.shipping import ship_by_value

ship_by_value(__name__)

# The vocabulary documents use, and the path of skolem ids.
VOCABULARY = "https://schema.org/"
GENID_MARK = "/genid/"
DEFAULT_GENID_BASE = "urn:genid/genid/"
#: Levels of unnamed nodes that are folded by joins before components are looked for.
FOLDS = 6


# ---- documents to quads ----------------------------------------------------------------------------

_STATEMENT = pa.schema(
    [
        ("s_id", pa.string()),
        ("s_path", pa.string()),
        ("p", pa.string()),
        ("kind", pa.string()),
        ("value", pa.string()),
        ("datatype", pa.string()),
        ("language", pa.string()),
        ("turned", pa.bool_()),
    ]
)
_STATEMENT_DDL = (
    "s_id string, s_path string, p string, kind string, value string, datatype string, "
    "language string, turned boolean"
)


# Documents whose statements are held at a time.
DOCUMENTS_AT_ONCE = 200
# Labelled nodes that a task gathers before it hands them on: components may be very many and very small.
LABELS_AT_ONCE = 10000
# Fixed value: the namespace of list nodes.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"


def _listed(value) -> list:
    return value if isinstance(value, list) else [value]


def _members(value) -> list:
    """The values of a property: lists in lists and `@set` count as their members."""
    out, pending = [], [value]
    while pending:
        item = pending.pop()
        if isinstance(item, list):
            pending.extend(reversed(item))
        elif isinstance(item, dict) and "@set" in item:
            pending.append(item["@set"])
        else:
            out.append(item)
    return out


def _text(value) -> str | None:
    return value if isinstance(value, str) and value else None


def read_document(text: str | None) -> tuple[object, str | None]:
    """The document, and why it cannot be read. A missing one is empty without an error."""
    try:
        return (json.loads(text) if text else None), None
    except (ValueError, RecursionError) as error:
        return None, type(error).__name__


class Terms:
    """What the inline contexts above a node say about names: terms, prefixes, `@vocab` and `@language`.

    Contexts that stand somewhere else are not fetched; they leave names as they are.
    """

    def __init__(self) -> None:
        self.known: dict[str, dict | None] = {}
        self.vocabulary: str | None = None
        self.language: str | None = None

    def under(self, context) -> Terms:
        """The terms below a node with this `@context`; null forgets all."""
        if context is None:
            return Terms()
        if isinstance(context, list):
            out = self
            for item in context:
                out = out.under(item)
            return out
        if not isinstance(context, dict):
            return self
        out = Terms()
        out.known, out.vocabulary, out.language = dict(self.known), self.vocabulary, self.language
        if "@vocab" in context:
            out.vocabulary = out.iri(context["@vocab"]) if _text(context["@vocab"]) else None
        if "@language" in context:
            out.language = _text(context["@language"])
        for name, given in context.items():
            if name[:1] != "@":
                out.known[name] = {"@id": given} if isinstance(given, str) else given if isinstance(given, dict) else None
        return out

    def of(self, name: str) -> dict:
        return self.known.get(name) or {}

    def dropped(self, name: str) -> bool:
        return name in self.known and self.known[name] is None

    def keyword(self, name: str) -> str:
        """The keyword that a name stands for, else the name."""
        given = _text(self.of(name).get("@id"))
        return given if given and given[:1] == "@" else name

    def name(self, name: str, steps: int = 8) -> str:
        """A property, type or datatype: by its term, its prefix or the vocabulary. What none knows stays as it is."""
        given = _text(self.of(name).get("@id")) or _text(self.of(name).get("@reverse"))
        if given and given != name and steps:
            return self.name(given, steps - 1)
        whole = self.iri(name, steps)
        return whole if whole != name or ":" in name or not self.vocabulary else self.vocabulary + name

    def iri(self, name: str, steps: int = 8) -> str:
        """An address, its prefix written out."""
        prefix, mark, rest = name.partition(":")
        if mark and steps and prefix != "_" and not rest.startswith("//") and _text(self.of(prefix).get("@id")):
            return self.name(prefix, steps - 1) + rest
        return name


def statements(text: str | None) -> Iterator[tuple]:
    """The statements of one document as (s_id, s_path, p, kind, value, datatype, language, turned).

    A node is named by its `@id`, or by its path in the document. The kind tells how `value` is to be read:
    iri, path (of an unnamed node), type, string, boolean, integer or double. A `@list` is a chain of unnamed nodes.
    Inline contexts hold for the node they stand in and all below it. Ids and types that are no strings, null values and
    members that are no nodes are passed over.
    """
    root, _ = read_document(text)
    pending = [(f"{i}", node, Terms()) for i, node in enumerate(_members(root)) if isinstance(node, dict)]
    while pending:
        path, node, above = pending.pop()
        names = above.under(node["@context"]) if "@context" in node else above
        fields, words = [], {}
        for key, value in node.items():
            word = names.keyword(key)
            if word[:1] == "@":
                words[word] = value
            elif not names.dropped(key):
                fields.append((key, value, "@reverse" in names.of(key)))
        given = _text(words.get("@id"))
        own = (names.iri(given) if given else None, path)
        for member in _members(words.get("@graph", [])):
            if isinstance(member, dict):
                pending.append((f"{path}/@graph/{len(pending)}", member, names))
        inverse = words.get("@reverse")
        if isinstance(inverse, dict):
            fields += [(key, value, True) for key, value in inverse.items()]
        for name in _members(words.get("@type", [])):
            if _text(name):
                yield (*own, "@type", "type", names.name(name), None, None, False)
        for key, value, turned in fields:
            rule, property_ = names.of(key), names.name(key)
            inner = names.under(rule["@context"]) if "@context" in rule else names
            where = f"{path}/{'^' if turned else ''}{key}"
            container = rule.get("@container")
            if container == "@list" and not (isinstance(value, dict) and "@list" in value):
                yield from _chain(own, property_, turned, f"{where}/0", _members(value), pending, inner, rule)
                continue
            if container == "@language" and isinstance(value, dict):
                value = [{"@value": said, "@language": language} for language, some in value.items() for said in _members(some)]
            elif container == "@index" and isinstance(value, dict):
                value = [item for some in value.values() for item in _members(some)]
            for i, item in enumerate(_members(value)):
                place = f"{where}/{i}"
                if isinstance(item, dict) and "@list" in item:
                    yield from _chain(own, property_, turned, place, _members(item["@list"]), pending, inner, rule)
                else:
                    yield from _statement(own, property_, turned, place, item, pending, inner, rule)


def _chain(own: tuple, key: str, turned: bool, place: str, items: list, pending: list, names: Terms, rule: dict) -> Iterator[tuple]:
    """A list: one unnamed node per member, each with its value and the node after it."""
    at = [f"{place}/@list/{k}" for k in range(len(items))]
    for k, after in enumerate([*at, None]):
        before, name, side = (own, key, turned) if k == 0 else ((None, at[k - 1]), RDF + "rest", False)
        if after is None:
            yield (*before, name, "iri", RDF + "nil", None, None, side)
        else:
            yield (*before, name, "path", after, None, None, side)
            yield from _statement((None, after), RDF + "first", False, f"{after}/0", items[k], pending, names, rule)


def _statement(own: tuple, key: str, turned: bool, place: str, item, pending: list, names: Terms, rule: dict) -> Iterator[tuple]:
    wanted = _text(rule.get("@type"))
    if isinstance(item, dict) and "@value" in item:
        given = item["@value"]
        if isinstance(given, (str, bool, int, float)):
            kind = "boolean" if isinstance(given, bool) else "string"
            printed = str(given).lower() if isinstance(given, bool) else str(given)
            datatype = _text(item.get("@type"))
            yield (*own, key, kind, printed, names.name(datatype) if datatype else None, _text(item.get("@language")), turned)
    elif isinstance(item, dict):
        words = {names.keyword(k): v for k, v in item.items() if k != "@context"}
        inner = names.under(item["@context"]) if "@context" in item else names
        name = _text(words.get("@id"))
        yield (*own, key, "iri" if name else "path", inner.iri(name) if name else place, None, None, turned)
        pending.append((place, item, names))
    elif isinstance(item, bool):
        yield (*own, key, "boolean", str(item).lower(), None, None, turned)
    elif isinstance(item, (int, float)):
        yield (*own, key, "integer" if isinstance(item, int) else "double", repr(item), None, None, turned)
    elif isinstance(item, str) and wanted in ("@id", "@vocab"):
        yield (*own, key, "iri", names.iri(item) if wanted == "@id" else names.name(item), None, None, turned)
    elif isinstance(item, str) and wanted and wanted[:1] != "@":
        yield (*own, key, "string", item, names.name(wanted), None, turned)
    elif isinstance(item, str):
        language = _text(rule["@language"]) if "@language" in rule else names.language
        yield (*own, key, "string", item, None, language, turned)


def rejected_documents(docs: DataFrame, graph: str = "g", raw: str = "raw") -> DataFrame:
    """`g` and `error` of the documents that cannot be read and so give no statements."""
    graph_name, raw_name = graph, raw

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            errors = [read_document(text.as_py())[1] for text in batch.column(raw_name)]
            out = pa.RecordBatch.from_arrays([batch.column(graph_name), pa.array(errors, pa.string())], ["g", "error"])
            yield out.filter(pa.array([e is not None for e in errors]))

    return docs.select(F.col(graph).cast("string").alias(graph), raw).mapInArrow(check, "g string, error string")


def document_statements(docs: DataFrame, graph: str = "g", raw: str = "raw") -> DataFrame:
    """The statements of each document with its graph id; only these two columns enter the Python stage."""
    graph_name, raw_name = graph, raw

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), *_STATEMENT.types]
        for whole in batches:
            for start in range(0, whole.num_rows, DOCUMENTS_AT_ONCE):
                batch = whole.slice(start, DOCUMENTS_AT_ONCE)
                names = batch.column(graph_name).to_pylist()
                texts = batch.column(raw_name).to_pylist()
                rows = [(g, *row) for g, text in zip(names, texts) for row in statements(text)]
                columns = list(zip(*rows)) if rows else [()] * (len(_STATEMENT) + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(columns, types)], names=["g", *_STATEMENT.names]
                )

    return docs.select(graph, raw).mapInArrow(walk, f"g string, {_STATEMENT_DDL}")


def _absolute(name: Column, vocabulary: str) -> Column:
    return F.when(name.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), name).otherwise(
        F.concat(F.lit(vocabulary), name)
    )


def quads_of_documents(
    docs: DataFrame,
    graph: str = "g",
    raw: str = "raw",
    vocabulary: str = VOCABULARY,
    genid_base: str = DEFAULT_GENID_BASE,
) -> DataFrame:
    """Distinct quads s, p, o, value, kind, datatype, language, g of JSON-LD documents.

    The tree walk gives statements; names, number forms, inverse properties and set semantics are relational.
    Unnamed nodes get an id made from the graph and their path, the same one on every run.
    """

    def genid(path: Column) -> Column:
        return F.concat(F.lit(genid_base), F.sha1(F.concat(F.col("g"), F.lit("|"), path)))

    number = F.col("value").try_cast("double")
    whole = (number == F.rint(number)) & (F.abs(number) < 1e21)
    kind = F.col("kind")
    rows = document_statements(docs, graph, raw).select(
        "g",
        F.coalesce("s_id", genid(F.col("s_path"))).alias("_node"),
        F.when(F.col("p") == "@type", F.lit(terms.RDF_TYPE))
        .otherwise(_absolute(F.col("p"), vocabulary))
        .alias("p"),
        F.when(kind == "path", genid(F.col("value")))
        .when(kind == "type", _absolute(F.col("value"), vocabulary))
        .when(
            (kind == "double") & whole, number.cast("decimal(38,0)").cast("string")
        )
        .when(kind == "double", terms.canonical_double(number))
        .otherwise(F.col("value"))
        .alias("_value"),
        F.when((kind == "iri") & F.startswith("value", F.lit("_:")), F.lit("bnode"))
        .when(kind.isin("path", "type", "iri"), F.lit("iri"))
        .otherwise(F.lit("literal"))
        .alias("_kind"),
        F.when(F.col("datatype").isNotNull(), _absolute(F.col("datatype"), vocabulary))
        .when(kind == "boolean", F.lit(terms.XSD + "boolean"))
        .when((kind == "integer") | ((kind == "double") & whole), F.lit(terms.XSD + "integer"))
        .when(kind == "double", F.lit(terms.XSD + "double"))
        .alias("datatype"),
        "language",
        "turned",
    )
    swap = F.col("turned") & (F.col("_kind") != "literal")
    as_node = F.when(F.startswith("_node", F.lit("_:")), F.lit("bnode")).otherwise(F.lit("iri"))
    placed = rows.select(
        F.when(swap, F.col("_value")).otherwise(F.col("_node")).alias("s"),
        "p",
        F.when(swap, F.col("_node")).otherwise(F.col("_value")).alias("value"),
        F.when(swap, as_node).otherwise(F.col("_kind")).alias("kind"),
        "datatype",
        "language",
        "g",
    )
    written = placed.withColumn(
        "o",
        terms.print_term(F.col("value"), F.col("kind"), F.col("datatype"), F.col("language")),
    )
    return written.dropDuplicates(["s", "p", "o", "g"])


# ---- releases --------------------------------------------------------------------------------------


def union_releases(*releases: DataFrame) -> DataFrame:
    """All quads of several releases, each once."""
    first, *rest = [r.select("s", "p", "o", "g") for r in releases]
    for other in rest:
        first = first.unionByName(other)
    return first.distinct()


def graph_summary(quads: DataFrame) -> DataFrame:
    """Quads per graph with the source and content hash that the graph id holds."""
    return (
        quads.groupBy("g")
        .agg(F.count("*").alias("n"))
        .withColumn("source", terms.graph_source(F.col("g")))
        .withColumn("sha", terms.graph_sha(F.col("g")))
    )


def predicate_profile(quads: DataFrame) -> DataFrame:
    return quads.groupBy("p").agg(F.count("*").alias("n"))


def type_profile(quads: DataFrame) -> DataFrame:
    return (
        quads.filter(F.col("p") == terms.RDF_TYPE)
        .groupBy(F.col("value").alias("type"))
        .agg(F.count("*").alias("n"))
    )


def entities(quads: DataFrame, type_iri: str, properties: dict[str, str]) -> DataFrame:
    """One row per entity of a type: g, s and a column per property (name to predicate).

    Type test and properties come from one aggregate on (g, s), without a self-join. Every property is the sorted
    array of its distinct values, empty if there are none; `entity_values` has them as rows.
    """
    is_type = F.bool_or((F.col("p") == terms.RDF_TYPE) & (F.col("value") == type_iri))
    wanted = [terms.RDF_TYPE, *properties.values()]
    return (
        quads.filter(F.col("p").isin(wanted))
        .groupBy("g", "s")
        .agg(
            is_type.alias("_is"),
            *[
                F.sort_array(F.collect_set(F.when(F.col("p") == predicate, F.col("value")))).alias(name)
                for name, predicate in properties.items()
            ],
        )
        .filter("_is")
        .drop("_is")
    )


def entity_values(quads: DataFrame, type_iri: str, predicates: list[str]) -> DataFrame:
    """Every value of the predicates on entities of a type: g, s, p, value."""
    typed = (
        quads.filter((F.col("p") == terms.RDF_TYPE) & (F.col("value") == type_iri))
        .select("g", "s")
        .distinct()
    )
    return (
        quads.filter(F.col("p").isin(predicates))
        .select("g", "s", "p", "value")
        .join(typed, ["g", "s"], "left_semi")
        .distinct()
    )


def follow(quads: DataFrame, type_iri: str, first: str, second: str) -> DataFrame:
    """Two steps from entities of a type: g, s, middle, value (`s first middle`, `middle second value`).

    The quads that the pattern names are written once; the joins read those, so that no line is parsed again.
    """
    is_type = (F.col("p") == terms.RDF_TYPE) & (F.col("value") == type_iri)
    named = quads.filter(is_type | F.col("p").isin(first, second))
    quads = cut_lineage(named.select("g", "s", "p", "value"))
    steps = entity_values(quads, type_iri, [first]).select(
        "g", "s", F.col("value").alias("middle")
    )
    ends = quads.filter(F.col("p") == second).select("g", F.col("s").alias("middle"), "value")
    return steps.join(ends, ["g", "middle"]).select("g", "s", "middle", "value").distinct()


# ---- comparison without regard to skolem ids -------------------------------------------------------


def is_anonymous(node: Column) -> Column:
    """A blank node, or a skolem id."""
    return F.startswith(node, F.lit("_:")) | F.contains(node, F.lit(GENID_MARK))


def _sums(*parts: Column) -> list[Column]:
    """Two sums of hashes and a count: a fingerprint of a multiset of rows that partial sums can build."""
    one = F.xxhash64(*parts).cast("decimal(20,0)")
    two = F.xxhash64(F.lit("second"), *parts).cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("_n"), F.sum(one).alias("_a"), F.sum(two).alias("_b")]


def _node_ids(keys: tuple[str, ...], node: Column, attempt: int) -> Column:
    """One number for a node of a graph: the components of different graphs never meet."""
    return F.xxhash64(F.to_json(F.struct(*[F.col(k).cast("string") for k in keys], node.alias("_node"))), F.lit(attempt))


def _numbered(nodes: DataFrame, keys: tuple[str, ...], **metrics: Column) -> tuple[DataFrame, dict]:
    """`nodes` (keys, node and more), written with `id`, a number of eight bytes that no two of them share, and measured."""
    for attempt in count():
        named = nodes.withColumn("id", _node_ids(keys, F.col("node"), attempt))
        out, seen = written_and_measured(named, **metrics) if metrics else (written(named), {})
        clashes = written(out.groupBy("id").agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1").select("id"))
        clash = not clashes.isEmpty()
        removed(clashes)
        if not clash:
            return out, seen
        removed(out)


def _by_component(nodes: DataFrame, links: DataFrame, label: Callable, roots: DataFrame | None = None) -> DataFrame:
    """`label(colours, links)` over each connected component: `id` and the columns that `label` gives.

    `nodes` has id and colour, `links` has id, p and to. A component is held by one task, as text per node
    and numbers per link; nodes outside all links are left out. The rows of a task come component after component, so
    millions of small ones cost what their rows cost. `roots` (id, root) has the components if they are known.
    """
    if roots is None:
        ends = links.select(F.col("id").alias("a"), F.col("to").alias("b"))
        roots = written_alone(lambda: components(ends).select(F.col("node").alias("id"), "root"))
    kind = nodes.schema["id"].dataType
    onward = links.groupBy("id").agg(F.collect_list(F.struct("p", "to")).alias("links"))
    whole = roots.join(shuffled(nodes), "id").join(shuffled(onward), "id", "left")

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[column.to_pylist() for column in batch.columns]))
        done: tuple[list, list, list] = ([], [], [])

        def handed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(done, (to_arrow_type(kind), pa.string(), pa.bool_()))], ["id", "hash", "ring"])
            for column in done:
                column.clear()
            return out

        for _, component in groupby(rows, itemgetter(0)):
            _, ids, colours, linked = zip(*component)
            number = {name: i for i, name in enumerate(ids)}
            inner = [(i, link["p"], number[link["to"]]) for i, found in enumerate(linked) for link in found or []]
            for column, given in zip(done, (ids, *label(list(colours), inner))):
                column.extend(given)
            if len(done[0]) >= LABELS_AT_ONCE:
                yield handed_on()
        if done[0]:
            yield handed_on()

    parts = whole.select("root", "id", "colour", "links").repartition("root").sortWithinPartitions("root")
    return parts.mapInArrow(of_task, f"id {kind.simpleString()}, hash string, ring boolean")


def node_hashes(quads: DataFrame, keys: tuple[str, ...] = ("g",)) -> DataFrame:
    """keys, node, hash, ring for every unnamed node: equal hashes for nodes with equal properties all the way down.

    `keys` name the graph a node belongs to. Properties are summed as hashes, never collected, so a node with very
    many properties stays a partial aggregate. A few rounds fold the hashes of unnamed children into their parents;
    that settles what is at most `FOLDS` levels above the last one. Nodes on rings, above them, or on longer chains are
    settled by connected components, which take as many rounds as the logarithm of their size: inside one, children come
    before parents, and a ring with all between its nodes counts as a whole (`ring`). The rows are written; what was written
    on the way is gone.
    """
    return written_alone(lambda: _node_hashes(quads, keys))


def _node_hashes(quads: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    at = [*keys, "node"]
    inner_node = (F.col("kind") != "literal") & is_anonymous(F.col("value"))
    own = quads.filter(is_anonymous(F.col("s"))).select(
        *keys, F.col("s").alias("node"), "p", "o", inner_node.alias("_inner"), "value"
    )
    outer = F.when(~F.col("_inner"), F.col("o")).otherwise(F.lit("(node)"))
    unsettled = F.count_if(~F.col("settled"))
    subjects = own.groupBy(*at).agg(*_sums(F.col("p"), outer), (F.count_if("_inner") == 0).alias("settled"))
    # Unnamed nodes that say nothing of themselves are nodes too.
    mute = quads.filter(inner_node).select(*keys, F.col("value").alias("node")).distinct()
    nought = F.lit(0).cast("decimal(30,0)")
    mute = mute.withColumns({"_n": F.lit(0).cast("long"), "_a": nought, "_b": nought, "settled": F.lit(True)})
    sums = [F.sum(c).alias(c) for c in ("_n", "_a", "_b")]
    all_nodes = subjects.unionByName(mute).groupBy(*at).agg(*sums, F.bool_and("settled").alias("settled"))
    current, seen = written_and_measured(
        all_nodes.select(*at, F.concat_ws("|", "_n", "_a", "_b").alias("base"), "settled").withColumn("hash", F.sha1("base")),
        unsettled=unsettled,
    )
    never = F.lit(False).alias("ring")
    if not seen["unsettled"]:
        return current.select(*at, "hash", never)
    links = written(own.filter("_inner").select(*at, "p", F.col("value").alias("inner")))
    for _ in range(FOLDS):
        inner = current.select(*keys, F.col("node").alias("inner"), F.col("hash").alias("_hash"), F.col("settled").alias("_settled"))
        folded = (
            links.join(shuffled(current.filter("not settled").select(*at)), at, "left_semi")
            .join(shuffled(inner), [*keys, "inner"])
            .groupBy(*at)
            .agg(
                *_sums(F.col("p"), F.when(F.col("_settled"), F.col("_hash")).otherwise(F.lit("(node)"))),
                F.bool_and("_settled").alias("_ready"),
            )
            .select(*at, F.concat_ws("|", "_n", "_a", "_b").alias("_folded"), "_ready")
        )
        last = current
        current, seen = written_and_measured(
            current.join(shuffled(folded), at, "left").select(
                *at,
                "base",
                F.when(F.col("settled"), F.col("hash")).otherwise(F.sha1(F.concat_ws("/", "base", "_folded"))).alias("hash"),
                F.coalesce("_ready", F.col("settled")).alias("settled"),
            ),
            unsettled=unsettled,
        )
        removed(last)
        if not seen["unsettled"]:
            return current.select(*at, "hash", never)
    # What is left already holds all that it says of settled nodes; the links among the rest decide.
    rest, _ = _numbered(current.filter("not settled").select(*at, F.col("hash").alias("colour")), keys)
    ends = rest.select(*keys, F.col("node").alias("inner"), F.col("id").alias("to"))
    among = written(links.join(shuffled(rest.select(*at, "id")), at).join(shuffled(ends), [*keys, "inner"]).select("id", "p", "to"))
    removed(links)
    found = _by_component(rest.select("id", "colour"), among, labelling.settled)
    named = rest.select(*at, "id").join(shuffled(found), "id").select(*at, "hash", "ring")
    return current.filter("settled").select(*at, "hash", never).unionByName(named)


def node_labels(quads: DataFrame, keys: tuple[str, ...] = ("g",)) -> DataFrame:
    """keys, node, hash: labels that are equal in two graphs exactly for nodes that correspond to each other.

    What a node leads to tells it, as long as only one node has that hash, or as its equals each hang below one
    place and off any ring: such trees are interchangeable. Equal nodes that are reached from several places, or lie on
    rings, are not. Those, and the equal nodes linked with them, are labelled by connected components, with all that leads to
    them from outside: components of equal form get equal labels (`labelling.labels`).
    """
    at = [*keys, "node"]
    hashes = node_hashes(quads, keys)
    inner_node = (F.col("kind") != "literal") & is_anonymous(F.col("value"))
    times = quads.filter(inner_node).groupBy(*keys, F.col("value").alias("node")).agg(F.count(F.lit(1)).alias("_in"))
    twins = written(hashes.groupBy(*keys, "hash").agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1").select(*keys, "hash"))
    equal = hashes.join(shuffled(twins), [*keys, "hash"]).join(shuffled(times), at, "left")
    tangled = F.col("ring") | (F.coalesce("_in", F.lit(0)) > 1)
    equal, seen = _numbered(equal.select(*at, "hash", tangled.alias("tangled")), keys, tangled=F.count_if("tangled"))
    removed(twins)
    if not seen["tangled"]:
        return hashes.select(*at, "hash")
    ends = equal.select(*keys, F.col("node").alias("value"), F.col("id").alias("to"))
    to_equal = quads.filter(inner_node).select(*keys, "s", "p", "value").join(shuffled(ends), [*keys, "value"])
    starts = equal.select(*keys, F.col("node").alias("s"), "id")
    from_outside = F.when(F.col("id").isNull(), F.col("s")).alias("s")
    to_equal = written(to_equal.join(shuffled(starts), [*keys, "s"], "left").select(*keys, from_outside, "p", "id", "to"))
    among = to_equal.filter("id is not null").select("id", "p", "to")
    # Every equal node stands in a component, if only with itself; those with a tangled node in them are labelled.
    selves = equal.select(F.col("id").alias("a"), F.col("id").alias("b"))
    ends = among.select(F.col("id").alias("a"), F.col("to").alias("b")).unionAll(selves)
    roots = written_alone(lambda: equal.join(shuffled(components(ends).withColumnRenamed("node", "id")), "id"))
    removed(equal)
    hard = written(roots.groupBy("root").agg(F.bool_or("tangled").alias("_hard")).filter("_hard").select("root"))
    core = written(roots.join(shuffled(hard), "root").select(*at, "id", "hash", "root"))
    removed(roots, hard)
    # Who leads to a node from outside its component: named subjects, and unnamed ones that are told by their hash.
    outside = to_equal.filter("id is null").join(shuffled(hashes.select(*keys, F.col("node").alias("s"), "hash")), [*keys, "s"], "left")
    lead = outside.groupBy(F.col("to").alias("id")).agg(*_sums(F.col("p"), F.coalesce("hash", "s")))
    lead = lead.select("id", F.concat_ws("|", "_n", "_a", "_b").alias("_lead"))
    colour = F.sha1(F.concat_ws("/", "hash", F.coalesce("_lead", F.lit(""))))
    coloured = written(core.join(shuffled(lead), "id", "left").select("id", colour.alias("colour")))
    inside = written(among.join(shuffled(core.select("id")), "id", "left_semi"))

    def labels(colours: list[str], links: list[tuple[int, str, int]]) -> tuple[list[str], list[bool]]:
        return labelling.labels(colours, [link for link in links if link[1]]), [False] * len(colours)

    removed(to_equal)
    found = written(_by_component(coloured, inside, labels, core.select("id", "root")).select("id", F.col("hash").alias("_label")))
    removed(coloured, inside)
    labelled = written(core.select(*at, "id").join(shuffled(found), "id").select(*at, "_label"))
    removed(core, found)
    return hashes.join(shuffled(labelled), at, "left").select(*at, F.coalesce("_label", "hash").alias("hash"))


def canonical(quads: DataFrame, keys: tuple[str, ...] = ("g",)) -> DataFrame:
    """Quads with every unnamed node replaced by `_:` and its label."""
    hashes = written_alone(lambda: node_labels(quads, keys))
    as_subject = hashes.select(*keys, F.col("node").alias("_from"), F.col("hash").alias("_s"))
    as_object = hashes.select(*keys, F.col("node").alias("_to"), F.col("hash").alias("_o"))
    outer = is_anonymous(F.col("s"))
    inner = (F.col("kind") != "literal") & is_anonymous(F.col("value"))
    columns = ["s", "p", "o", *keys]
    named = quads.filter(~outer & ~inner).select(*columns)
    # A row that needs one of the two joins only takes a key of its own to the other: equal keys would meet in one task.
    apart = F.concat(F.lit("\u0001"), F.xxhash64("s", "p", "o").cast("string"))
    touched = quads.filter(outer | inner).select(
        # A node that is replaced travels as a key only.
        F.when(outer, F.lit(None)).otherwise(F.col("s")).alias("s"),
        "p",
        F.when(inner, F.lit(None)).otherwise(F.col("o")).alias("o"),
        *keys,
        outer.alias("_outer"),
        inner.alias("_inner"),
        F.when(outer, F.col("s")).otherwise(apart).alias("_from"),
        F.when(inner, F.col("value")).otherwise(apart).alias("_to"),
    )
    replaced = (
        touched.join(shuffled(as_subject), [*keys, "_from"], "left")
        .join(shuffled(as_object), [*keys, "_to"], "left")
        .select(
            F.when(F.col("_outer"), F.concat(F.lit("_:"), F.coalesce("_s", F.lit("none"))))
            .otherwise(F.col("s"))
            .alias("s"),
            "p",
            F.when(F.col("_inner"), F.concat(F.lit("_:"), F.coalesce("_o", F.lit("none"))))
            .otherwise(F.col("o"))
            .alias("o"),
            *keys,
        )
    )
    return named.unionByName(replaced)


def compare_releases(left: DataFrame, right: DataFrame) -> DataFrame:
    """Quads that one release has more often than the other: s, p, o, g, side, n.

    Both releases go through one canonical form, told apart by a sign, and meet in one signed count, so equal
    unnamed nodes are compared as a multiset. No row is left exactly if the graphs of both sides are equal but for the names
    of unnamed nodes. A difference shows in the quads of the nodes above it, and in all quads of a component of
    equal nodes that are tangled by shared places or rings.
    """
    columns = ["s", "p", "o", "value", "kind", "g"]
    both = (
        left.select(*columns, F.lit(1).alias("_sign"))
        .unionByName(right.select(*columns, F.lit(-1).alias("_sign")))
    )
    # Read by every round: written once, so that no round parses the releases again.
    both = written(both.withColumn("g", F.coalesce("g", F.lit(""))))
    return (
        canonical(both, ("_sign", "g"))
        .groupBy("s", "p", "o", "g")
        .agg(F.sum("_sign").alias("_d"))
        .filter(F.col("_d") != 0)
        .select(
            "s",
            "p",
            "o",
            "g",
            F.when(F.col("_d") > 0, F.lit("left")).otherwise(F.lit("right")).alias("side"),
            F.abs("_d").alias("n"),
        )
    )


def difference_profile(differences: DataFrame) -> DataFrame:
    return differences.groupBy("p", "side").agg(F.sum("n").alias("n"))
