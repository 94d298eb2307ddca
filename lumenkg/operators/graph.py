"""Knowledge-graph outputs: JSON-LD, triples, graph entities and tables
(K1-K6, A8).  All native Column expressions; the per-article triple set
is built as an array of structs and exploded with ``inline``."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab
from ..functions.text import article_id, non_empty, or_empty_array, truthy

S, B, SP, DC = vocab.SCHEMA_NS, vocab.BIO_NS, vocab.SPACE_NS, vocab.DCTERMS_NS


def iso_datetime(c) -> Column:
    """``datetime.isoformat()``: seconds, plus microseconds when non-zero."""
    c = F.col(c) if isinstance(c, str) else c
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    return F.when(c.isNotNull(), F.when(micros == "000000", base).otherwise(F.concat(base, F.lit("."), micros)))


def _t(s: Column, p: str, o: Column, kind: str) -> Column:
    return F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"))


def _node_uri(kind: str, name: Column) -> Column:
    return F.concat(F.lit(f"{vocab.BASE_URI}{kind}/"), F.md5(F.coalesce(name, F.lit(""))))


def triples_array(id_col: Column | None = None) -> Column:
    """K3: the distinct triples of one article as ``array<struct<s,p,o,o_kind>>``."""
    a = article_id() if id_col is None else id_col
    rdf_type = vocab.RDF_TYPE
    single = [
        F.array(_t(a, rdf_type, F.lit(S + "ScholarlyArticle"), "uri")),
        F.array(_t(a, S + "name", F.col("title"), "literal")),
        F.when(truthy("url"), F.array(_t(a, S + "url", F.col("url"), "uri"))),
        F.when(truthy("abstract"), F.array(_t(a, S + "abstract", F.col("abstract"), "literal"))),
        F.when(truthy("full_text"), F.array(_t(a, S + "text", F.col("full_text"), "literal"))),
        F.when(F.col("publication_date").isNotNull(),
               F.array(_t(a, DC + "created", iso_datetime("publication_date"), "literal"))),
        F.array(_t(a, SP + "llmExtracted",
                   F.when(F.coalesce(F.col("llm_extracted"), F.lit(False)), F.lit("true")).otherwise(F.lit("false")),
                   "literal")),
        F.when(F.col("llm_confidence_score") > 0,
               F.array(_t(a, SP + "llmConfidenceScore", F.col("llm_confidence_score").cast("string"), "literal"))),
    ]
    j = _node_uri("journal", F.col("journal"))
    journal = F.when(truthy("journal"), F.array(
        _t(j, rdf_type, F.lit(S + "Periodical"), "uri"),
        _t(j, S + "name", F.col("journal"), "literal"),
        _t(a, S + "isPartOf", j, "uri")))

    def author_triples(x):
        name = F.coalesce(x["name"], F.lit(""))
        u = _node_uri("author", name)
        o = _node_uri("org", x["affiliation"])
        base = F.array(_t(u, rdf_type, F.lit(S + "Person"), "uri"), _t(u, S + "name", name, "literal"),
                       _t(a, S + "author", u, "uri"))
        aff = F.array(_t(o, rdf_type, F.lit(S + "Organization"), "uri"),
                      _t(o, S + "name", x["affiliation"], "literal"), _t(u, S + "affiliation", o, "uri"))
        return F.when(truthy(x["affiliation"]), F.concat(base, aff)).otherwise(base)

    authors = F.flatten(F.transform(F.coalesce(F.col("authors"), F.array()), author_triples))
    ids = [
        F.when(truthy("doi"), F.array(_t(a, S + "doi", F.col("doi"), "literal"))),
        F.when(truthy("pmid"), F.array(_t(a, B + "pmid", F.col("pmid"), "literal"))),
        F.when(truthy("pmcid"), F.array(_t(a, B + "pmcid", F.col("pmcid"), "literal"))),
    ]

    def term_triples(kind, type_uri, link):
        def f(x):
            u = _node_uri(kind, x)
            return F.array(_t(u, rdf_type, F.lit(type_uri), "uri"), _t(u, S + "name", x, "literal"),
                           _t(a, link, u, "uri"))
        return f

    kws = F.flatten(F.transform(or_empty_array("keywords"), term_triples("keyword", S + "DefinedTerm", S + "keywords")))
    orgs = F.flatten(F.transform(or_empty_array("organisms"), term_triples("organism", B + "Organism", SP + "studiesOrganism")))
    empty = F.array().cast("array<struct<s:string,p:string,o:string,o_kind:string>>")
    parts = [F.coalesce(p, empty) for p in single + [journal] + ids] + [authors, kws, orgs]
    return F.array_distinct(F.concat(*parts))


def to_triples(df: DataFrame, keep=("article_id",)) -> DataFrame:
    """K3 exploded: one row per (article, triple)."""
    base = df.withColumn("article_id", article_id()) if "article_id" not in df.columns else df
    return base.select(*[F.col(k) for k in keep], F.inline(triples_array(F.col("article_id"))))


def merge_triples(triples: DataFrame) -> DataFrame:
    """The graph as a set of (s, p, o, o_kind)."""
    return triples.select("s", "p", "o", "o_kind").dropDuplicates()


def graph_tables(triples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K5: node table (uri, type, names) and edge table (src, predicate, dst), both lazy."""
    t = merge_triples(triples)
    # one aggregation over the describing triples: a node has a row per type, with all its names
    described = t.filter(F.col("p").isin(vocab.RDF_TYPE, S + "name")).groupBy(F.col("s").alias("uri")).agg(
        F.collect_set(F.when(F.col("p") == vocab.RDF_TYPE, F.col("o"))).alias("types"),
        F.sort_array(F.collect_set(F.when(F.col("p") == S + "name", F.col("o")))).alias("names"))
    nodes = described.select("uri", F.explode("types").alias("type"), "names")
    edges = t.filter((F.col("o_kind") == "uri") & (F.col("p") != vocab.RDF_TYPE)) \
        .select(F.col("s").alias("src"), F.col("p").alias("predicate"), F.col("o").alias("dst"))
    return nodes, edges


def in_degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("dst").alias("uri")).agg(F.count("*").alias("in_degree"))


def graph_counts(triples: DataFrame) -> DataFrame:
    """K5 in numbers (kind, name, n): nodes by type, edges by predicate and the largest in-degree, from one
    pass over the merged triples: each gives a row for what it counts to, counted before the shuffle."""
    t = merge_triples(triples)
    edge = (F.col("o_kind") == "uri") & (F.col("p") != vocab.RDF_TYPE)
    row = lambda kind, name: F.struct(F.lit(kind).alias("kind"), F.col(name).alias("name"))
    rows = t.select(F.explode(F.when(F.col("p") == vocab.RDF_TYPE, F.array(row("node", "o")))
                              .when(edge, F.array(row("edge", "p"), row("max_in_degree", "o")))).alias("x"))
    each = rows.groupBy("x.kind", "x.name").agg(F.count("*").alias("n"))
    hub = F.col("kind") == "max_in_degree"
    return each.groupBy("kind", F.when(hub, F.lit("any")).otherwise(F.col("name")).alias("name")).agg(F.max("n").alias("n"))


def _author_ld(x) -> Column:
    aff = F.when(truthy(x["affiliation"]), F.struct(F.lit("schema:Organization").alias("@type"),
                                                   x["affiliation"].alias("schema:name")))
    return F.struct(F.lit("schema:Person").alias("@type"), F.coalesce(x["name"], F.lit("")).alias("schema:name"),
                    aff.alias("schema:affiliation"))


def _ident(kind: str, c: str) -> Column:
    return F.when(truthy(c), F.struct(F.lit("schema:PropertyValue").alias("@type"),
                                      F.lit(kind).alias("schema:propertyID"), F.col(c).alias("schema:value")))


def json_ld_struct(profile: str = "main") -> Column:
    """K1 / K2 as a struct whose field names are the JSON-LD keys."""
    ctx = F.struct(*[F.lit(v).alias(k) for k, v in vocab.JSONLD_CONTEXT.items()])
    idents = F.array_compact(F.array(_ident("DOI", "doi"), _ident("PMID", "pmid"), _ident("PMCID", "pmcid")))
    optional = [
        F.when(truthy("journal"), F.struct(F.lit("schema:Periodical").alias("@type"),
                                          F.col("journal").alias("schema:name"))).alias("schema:isPartOf"),
        F.when(non_empty("authors"), F.transform("authors", _author_ld)).alias("schema:author"),
        F.when(F.size(idents) > 0, idents).alias("schema:identifier"),
        F.when(non_empty("keywords"), F.col("keywords")).alias("schema:keywords"),
        F.when(non_empty("mesh_terms"), F.col("mesh_terms")).alias("bio:mesh_terms"),
    ]
    head = [ctx.alias("@context"), article_id().alias("@id"), F.lit("schema:ScholarlyArticle").alias("@type"),
            F.col("title").alias("schema:name")]
    if profile == "main":
        return F.struct(*head, F.coalesce(F.col("url"), F.lit("")).alias("schema:url"),
                        F.col("extraction_source").alias("extraction_source"),
                        F.col("llm_extracted").alias("llm_extracted"),
                        F.col("llm_confidence_score").alias("llm_confidence_score"),
                        F.when(F.col("publication_date").isNotNull(), iso_datetime("publication_date")).alias("dcterms:created"),
                        F.when(truthy("abstract"), F.col("abstract")).alias("schema:abstract"),
                        F.when(truthy("full_text"), F.col("full_text")).alias("schema:text"),
                        *optional)
    return F.struct(*head, F.col("url").alias("schema:url"),
                    iso_datetime("publication_date").alias("dcterms:created"),
                    F.col("abstract").alias("schema:abstract"), F.col("full_text").alias("schema:text"),
                    *optional)


def to_json_ld(profile: str = "main") -> Column:
    """K1 (main: absent keys omitted) / K2 (strict: url, created, abstract,
    text always present, possibly null) as a JSON string."""
    js = F.to_json(json_ld_struct(profile))
    if profile == "main":
        return js
    # strict: every non-null key, then explicit nulls of the four fixed keys
    fixed = [(F.col("url"), "schema:url"), (iso_datetime("publication_date"), "dcterms:created"),
             (F.col("abstract"), "schema:abstract"), (F.col("full_text"), "schema:text")]
    nulls = F.concat(*[F.when(c.isNull(), F.lit(f',"{k}":null')).otherwise(F.lit("")) for c, k in fixed])
    return F.concat(F.regexp_replace(js, r"\}$", ""), nulls, F.lit("}"))


def with_json_ld(df: DataFrame, profile: str = "main", out: str = "json_ld") -> DataFrame:
    return df.withColumn(out, to_json_ld(profile))


def graph_entities() -> Column:
    """K4: Article struct, Authors and the eight entity lists."""
    art = F.struct(article_id().alias("id"), F.col("title").alias("title"),
                   iso_datetime("publication_date").alias("date"), F.col("journal").alias("journal"),
                   F.col("quality_score").alias("quality_score"), F.col("extraction_source").alias("extraction_source"),
                   F.col("llm_extracted").alias("llm_extracted"),
                   F.col("llm_confidence_score").alias("llm_confidence_score"))
    authors = F.transform(F.coalesce(F.col("authors"), F.array()), lambda x: F.struct(
        F.coalesce(x["name"], F.lit("")).alias("name"), x["affiliation"].alias("affiliation")))
    lists = [("Keywords", "keywords"), ("MeshTerms", "mesh_terms"), ("Organisms", "organisms"), ("Genes", "genes"),
             ("Proteins", "proteins"), ("Conditions", "conditions"), ("Experiments", "experiments"),
             ("Measurements", "measurements")]
    return F.struct(art.alias("Article"), authors.alias("Authors"),
                    *[or_empty_array(c).alias(n) for n, c in lists])


def standardize(df: DataFrame, fields: list[str]) -> DataFrame:
    """K6: the four-part output record per (already deduplicated) article."""
    return df.select(
        F.struct(*[F.col(f) for f in fields]).alias("article_data"),
        to_json_ld("main").alias("json_ld"),
        F.transform(triples_array(), lambda t: F.array(t["s"], t["p"], t["o"])).alias("rdf_triples"),
        graph_entities().alias("graph_entities"),
    )
