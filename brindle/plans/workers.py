"""The pipeline's workers as composed queries: each takes tables and returns the rows to append to the state table, or to the serving stores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import providers
from ..config import DEFAULTS, Settings
from ..functions import kinds, texts, urls
from ..operators import cluster, graph, ingest, port, search, state, store, trend
from ..operators.durable import Tables, cut
from ..schemas import DIGEST

# The states of an item.
COLLECTED, EMBEDDED, EXTRACTED, DIGESTED, CLUSTERED, CONSOLIDATED = "collected", "embedded", "extracted", "digested", "clustered", "consolidated"
STORED, SERVED, SERVED_LINKS = "stored", "served", "linked"
BEAN_FIELDS = {"url": "string", "title": "string", "content": "string", "summary": "string", "source": "string", "base_url": "string", "kind": "string", "author": "string", "created": "timestamp", "collected": "timestamp"}


def collect(state_table: DataFrame, items: DataFrame, as_of: Column, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """Collector triage: the rows to append for storable beans, chatters and publishers, and the beans to scrape."""
    clean = ingest.cleanup_items(items, as_of)
    have = set(clean.columns)
    args = {c: F.col(c) for c in ("url", "base_url", "title", "summary", "description", "tags", "content", "source", "site_name") if c in have}
    guess = kinds.content_kind(**args, own_feed=F.col("rss_feed") if "rss_feed" in have else None)
    clean = clean.withColumn("kind", F.coalesce(F.col("kind"), guess) if "kind" in have else guess)
    clean = Tables(clean.sparkSession, "collected").cut(clean)  # made and written once, as all four results come from it, and each reads the columns that it needs
    beans, chatters, publishers = ingest.split_items(clean)
    good = ingest.triage(ingest.valid_beans(beans), settings.words_for_storing)
    fresh = state.deduplicate(state_table, good.withColumn("id", F.col("url")), COLLECTED)
    out = {"beans": state.put(state_table, fresh.where("triage = 'store'").drop("triage"), COLLECTED, object_type="beans", as_of=as_of), "scrape": fresh.where("triage = 'scrape'").drop("triage", "id")}
    if "chatter_url" in have:
        out["chatters"] = ingest.valid_chatters(chatters)
    if "source" in have:
        out["publishers"] = ingest.valid_publishers(publishers)
    return out


def _queue(state_table: DataFrame, done: str, fields: dict[str, str], settings: Settings, as_of: Column, include: str = COLLECTED) -> DataFrame:
    rows = state.get_one(state_table, include, done, object_type="beans", window_days=settings.processing_window_days, as_of=as_of, limit=settings.processing_limit)
    return rows.select("id", F.from_json("data", ", ".join(f"`{k}` {v}" for k, v in fields.items())).alias("d")).select("id", "d.*")


def embed(state_table: DataFrame, categories: DataFrame, sentiments: DataFrame, as_of: Column, *, build: Callable = providers.HashEmbedder, settings: Settings = DEFAULTS) -> DataFrame:
    """Vectors of collected items and their nearest labels."""
    queue = _queue(state_table, EMBEDDED, {"content": "string"}, settings, as_of)
    made = providers.embed(queue, build, max_chars=settings.max_document_len << 1).where(search.valid(F.col("embedding"), settings.vector_len)).select("id", "embedding")
    for name, labels in (("categories", categories), ("sentiments", sentiments)):
        found = search.nearest_labels(made.select("id", "embedding"), labels, k=settings.classification_limit).withColumnRenamed("labels", name)
        made = made.join(found, "id", "left")
    return state.put(state_table, made, EMBEDDED, object_type="beans", as_of=as_of)


def extract(state_table: DataFrame, as_of: Column, *, build: Callable = providers.PatternExtractor, settings: Settings = DEFAULTS) -> DataFrame:
    """Entities of collected items, as tags."""
    queue = _queue(state_table, EXTRACTED, {"content": "string"}, settings, as_of)
    made = providers.extract(queue, build).select("id", "found.*")
    return state.put(state_table, texts.normalize_fields(made), EXTRACTED, object_type="beans", as_of=as_of)


def digest(state_table: DataFrame, as_of: Column, *, build: Callable = providers.LeadAnalyst, settings: Settings = DEFAULTS) -> DataFrame:
    """Structured digests of collected items, normalised."""
    queue = _queue(state_table, DIGESTED, {"title": "string", "content": "string", "created": "timestamp"}, settings, as_of)
    prompt = queue.withColumn("prompt", port.render(queue, ["title", "created", "content"]))
    made = providers.analyse(prompt.select("id", "prompt"), DIGEST, build, text_col="prompt", out="digest", max_prompt_words=settings.max_document_len).where("digest is not null").select("id", "digest.*")
    return state.put(state_table, texts.normalize_fields(made), DIGESTED, object_type="beans", as_of=as_of)


def cluster_related(state_table: DataFrame, as_of: Column, *, settings: Settings = DEFAULTS, index: str | None = None) -> DataFrame:
    """Related items of those newly embedded, among all that are embedded: a search for the new ones, not all pairs again.

    With ``index`` (a vector index that ``vectorindex.build`` began) the search goes through it, and it takes the new ones in; without, it reads all stored vectors.
    """
    fields = {"embedding": "array<float>"}
    if index:
        queue = cut(_queue(state_table, CLUSTERED, fields, settings, as_of, EMBEDDED).where("embedding is not null"))
        found = cluster.related_through(index, queue, settings.cluster_eps, limit=settings.cluster_limit)
        return state.put(state_table, found, CLUSTERED, object_type="beans", as_of=as_of)
    everything = state_table.where((F.col("state") == EMBEDDED) & F.col("data").isNotNull()).select("id", F.from_json("data", "embedding array<float>").alias("d")).select("id", "d.embedding").where("embedding is not null")
    queue = _queue(state_table, CLUSTERED, fields, settings, as_of, EMBEDDED).where("embedding is not null")
    found = cluster.related_to(everything, queue, settings.cluster_eps, limit=settings.cluster_limit)
    return state.put(state_table, found, CLUSTERED, object_type="beans", as_of=as_of)


def group_facts(members: DataFrame, by: str, date_col: str) -> DataFrame:
    """Of each (bounded) group: its newest date, its members' ids and the union of their tags."""
    tags = F.array_distinct(F.flatten(F.collect_list(texts.merge_lists(F.col("regions"), F.col("entities")))))
    return members.groupBy(by).agg(F.max(date_col).alias("newest"), F.array_sort(F.collect_set("id")).alias("related"), tags.alias("tags"))


def consolidate(state_table: DataFrame, as_of: Column, *, number: Callable[[DataFrame], DataFrame] | None = None, build: Callable = providers.LeadAnalyst, settings: Settings = DEFAULTS, ignored_tags: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Composites of dense groups of digested items, and the marks of their members."""
    fields = {"embedding": "array<float>", "briefing": "string", "created": "timestamp", "related": "array<string>", "regions": "array<string>", "entities": "array<string>"}
    merged = state.get_many(state_table, [COLLECTED, EMBEDDED, EXTRACTED, DIGESTED, CLUSTERED], CONSOLIDATED, fields=fields, object_type="beans", window_days=settings.processing_window_days, as_of=as_of, limit=settings.processing_limit)
    tags = texts.merge_lists(F.col("regions"), F.col("entities"))
    fit = merged.where(search.valid(F.col("embedding"), settings.vector_len) & F.col("briefing").isNotNull())
    if ignored_tags:
        fit = fit.where(~F.coalesce(F.arrays_overlap(tags, F.array(*[F.lit(t) for t in ignored_tags])), F.lit(False)))
    # numbers for the ids, written once so that every use sees the same
    keyed = cut(fit.select("id", "embedding").withColumn("n", F.monotonically_increasing_id()))
    groups = cluster.dbscan(keyed.select("n", "embedding"), settings.consolidation_eps, settings.consolidation_min_size, id_col="n").join(keyed.select("n", "id"), "n").select("cluster", "id")
    recent = fit.where(F.col("created") >= as_of - F.expr(f"INTERVAL {settings.consolidation_related_days} DAYS"))
    grown = cluster.expand_groups(groups, merged.select("id", "related"), recent.select("id"), most=settings.consolidation_max_size, least=settings.consolidation_min_size)
    chunks = cluster.chunk_groups(grown, most=settings.consolidation_max_size, least=settings.consolidation_min_size).withColumn("group", F.concat_ws("-", F.col("cluster").cast("string"), F.col("chunk").cast("string")))
    full = chunks.join(fit, "id")
    prompt = port.render_groups(full, "group", ["created", "briefing", "regions", "entities"], ["created", "id"])
    told = providers.analyse(prompt, DIGEST, build, text_col="text", out="digest").where("digest is not null").select("group", "digest.*")
    about = group_facts(full, "group", "created").withColumnRenamed("newest", "created")
    composites = told.join(about, "group").join(search.median_vector(full, "group"), "group")
    composites = composites.withColumn("id", urls.dated_id(F.col("briefing"), as_of)).drop("group")
    return {"composites": state.put(state_table, composites, COLLECTED, object_type="composites", as_of=as_of), "marks": state.mark_done(state_table, full.select("id").distinct(), [CONSOLIDATED], as_of)}


def port_beans(state_table: DataFrame, beans: DataFrame, as_of: Column, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """Rows to append to the serving store (beans, and what is related to them), and marks; trends are refreshed after by refresh_trends."""
    fields = BEAN_FIELDS | {"embedding": "array<float>", "categories": "array<string>", "sentiments": "array<string>", "regions": "array<string>", "people": "array<string>", "companies": "array<string>", "products": "array<string>", "stock_tickers": "array<string>"}
    merged = state.get_many(state_table, [COLLECTED, EMBEDDED, EXTRACTED], STORED, fields=fields, object_type="beans", window_days=settings.processing_window_days, as_of=as_of, limit=settings.processing_limit)
    rows = port.beans(merged).where(search.valid(F.col("embedding"), settings.vector_len))
    new = store.insert_ignore(beans, rows.select(*[c for c in beans.columns if c in rows.columns]), ["url"])
    near = state.get_one(state_table, CLUSTERED, STORED, object_type="beans", window_days=settings.processing_window_days, as_of=as_of).select("id", F.from_json("data", "related array<string>")["related"].alias("related"))
    return {"beans": new, "related": graph.symmetric(graph.explode_edges(near, "id", "related")), "marks": state.mark_done(state_table, merged.select("id"), [STORED], as_of)}


def port_publishers(state_table: DataFrame, publishers: DataFrame, as_of: Column, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """Collected publishers that the serving store lacks, and marks."""
    fields = {"source": "string", "base_url": "string", "site_name": "string", "description": "string", "favicon": "string", "rss_feed": "string"}
    merged = state.get_many(state_table, [COLLECTED], STORED, fields=fields, object_type="publishers", window_days=settings.processing_window_days, as_of=as_of, limit=settings.processing_limit)
    rows = ingest.valid_publishers(merged.drop("id", "ts"))
    new = store.insert_ignore(publishers, rows.select(*[c for c in publishers.columns if c in rows.columns]), ["base_url"])
    return {"publishers": new, "marks": state.mark_done(state_table, merged.select("id"), [STORED], as_of)}


def port_chatters(state_table: DataFrame, as_of: Column, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """Packed snapshots {chatters: [...]} as rows to append, and marks."""
    kind = "array<struct<chatter_url:string,url:string,source:string,forum:string,collected:timestamp,likes:long,comments:long,subscribers:long>>"
    packed = state.get_one(state_table, COLLECTED, STORED, object_type="chatters", window_days=settings.processing_window_days, as_of=as_of).select("id", F.from_json("data", f"chatters {kind}")["chatters"].alias("chatters"))
    return {"chatters": ingest.valid_chatters(port.chatters(packed)), "marks": state.mark_done(state_table, packed.select("id"), [STORED], as_of)}


def refresh_trends(beans: DataFrame, chatters: DataFrame, related: DataFrame, as_of: Column) -> DataFrame:
    return trend.trend_aggregates(beans, chatters, related, as_of)


def port_sips(state_table: DataFrame, sips: DataFrame, as_of: Column, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """Events of digested items, and marks."""
    fields = BEAN_FIELDS | {"embedding": "array<float>", "categories": "array<string>", "regions": "array<string>", "people": "array<string>", "companies": "array<string>", "products": "array<string>", "stock_tickers": "array<string>", "briefing": "string", "events": "array<string>", "event_type": "string", "impact_level": "string"}
    merged = state.get_many(state_table, [COLLECTED, EMBEDDED, EXTRACTED, DIGESTED], SERVED, fields=fields, object_type="beans", window_days=settings.processing_window_days, as_of=as_of, limit=settings.processing_limit)
    made = port.events(merged, digest_fields=["briefing", "events", "event_type", "impact_level", "people", "companies", "products", "regions"], tag_fields=["regions", "people", "companies", "products", "categories"], max_tags=settings.max_tags)
    return {"sips": port.storable_sips(sips, made, settings.vector_len), "marks": state.mark_done(state_table, merged.select("id"), [SERVED], as_of)}


def port_signals(state_table: DataFrame, sips: DataFrame, as_of: Column, *, prefix: str = "signal://", settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """Signals of composites, the events that they derive from as typed edges, and marks."""
    fields = {"created": "timestamp", "embedding": "array<float>", "briefing": "string", "regions": "array<string>", "entities": "array<string>", "tags": "array<string>", "related": "array<string>"}
    merged = state.get_many(state_table, [COLLECTED], SERVED, fields=fields, object_type="composites", window_days=settings.processing_window_days, as_of=as_of, limit=settings.processing_limit)
    made = port.signals(merged, prefix=prefix, digest_fields=["briefing", "regions", "entities"], tag_fields=["regions", "entities", "tags"], max_tags=settings.max_tags)
    edges = graph.explode_edges(merged.select(urls.uuid5(F.concat(F.lit(prefix), F.col("id"))).alias("signal"), F.transform("related", lambda u: urls.uuid5(u)).alias("events")), "signal", "events", from_name="from_id", to_name="to_id")
    return {"sips": port.storable_sips(sips, made, settings.vector_len), "relations": graph.relations(edges, "DERIVED_FROM", as_of), "marks": state.mark_done(state_table, merged.select("id"), [SERVED], as_of)}


def port_sources(state_table: DataFrame, sources: DataFrame, events: DataFrame, as_of: Column, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """Publishers as sources of the serving store, the PUBLISHED edges to the events at hand, and marks."""
    fields = {"source": "string", "base_url": "string", "site_name": "string", "description": "string", "favicon": "string", "rss_feed": "string"}
    merged = state.get_many(state_table, [COLLECTED], SERVED, fields=fields, object_type="publishers", window_days=settings.processing_window_days, as_of=as_of, limit=settings.processing_limit)
    made = port.sources(ingest.valid_publishers(merged), as_of)
    new = store.insert_ignore(sources, made.select(*[c for c in sources.columns if c in made.columns]), ["id"])
    return {"sources": new, "relations": graph.published(made, events, as_of), "marks": state.mark_done(state_table, merged.select("id"), [SERVED], as_of)}


def port_relations(state_table: DataFrame, nodes: DataFrame, as_of: Column, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """SAME_AS edges of clustered items whose two ends are served, and marks."""
    near = state.get_one(state_table, CLUSTERED, SERVED_LINKS, object_type="beans", window_days=settings.processing_window_days, as_of=as_of).select("id", F.from_json("data", "related array<string>")["related"].alias("related"))
    edges = graph.explode_edges(near.select(urls.uuid5(F.col("id")).alias("a"), F.transform("related", lambda u: urls.uuid5(u)).alias("b")), "a", "b", from_name="from_id", to_name="to_id").where("from_id <> to_id")
    return {"relations": graph.relations(graph.resolved(edges, nodes, "id"), "SAME_AS", as_of), "marks": state.mark_done(state_table, near.select("id"), [SERVED_LINKS], as_of)}


def backfill_ids(df: DataFrame, url_col: str = "url", id_col: str = "id") -> DataFrame:
    return df.withColumn(id_col, F.coalesce(F.col(id_col), urls.uuid5(F.col(url_col))) if id_col in df.columns else urls.uuid5(F.col(url_col)))


def clean_tag_columns(df: DataFrame, columns: tuple[str, ...] = ("regions", "entities", "categories", "sentiments")) -> DataFrame:
    """Tags without signs at their ends, without empty ones and repeats."""
    bare = lambda c: F.array_distinct(F.filter(F.transform(F.col(c), lambda t: F.regexp_replace(t, r"(?U)^\W+|\W+$", "")), lambda t: t != ""))
    return df.withColumns({c: bare(c) for c in columns if c in df.columns})


def promote_column(df: DataFrame, new: str, old: str) -> DataFrame:
    """A staged column takes the place of the old one."""
    return df.drop(old).withColumnRenamed(new, old)


def reembed(df: DataFrame, categories: DataFrame, *, build: Callable = providers.HashEmbedder, settings: Settings = DEFAULTS) -> DataFrame:
    """Vectors and labels for rows that lack a vector."""
    made = providers.embed(df.where("embedding is null").drop("embedding", "categories"), build)
    return made.join(search.nearest_labels(made.select("id", "embedding"), categories, k=settings.classification_limit).withColumnRenamed("labels", "categories"), "id", "left")


def hydrate_vectors(collection: DataFrame, beans: DataFrame, as_of: Column, *, days: int = 90) -> DataFrame:
    """Rows to append to a vector collection (id, ts, embedding): recent beans that it lacks."""
    recent = beans.where((F.col("created") >= as_of - F.expr(f"INTERVAL {days} DAYS")) & F.col("embedding").isNotNull())
    return store.insert_ignore(collection, recent.select(F.col("url").alias("id"), F.col("created").alias("ts"), "embedding"), ["id"])


def update_embeddings(beans: DataFrame, updates: DataFrame, categories: DataFrame, sentiments: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The beans with new vectors (url, embedding) and the labels nearest to them."""
    new = updates.where(search.valid(F.col("embedding"), settings.vector_len))
    new = store.one_of_each(new, ["url"])
    for name, labels in (("categories", categories), ("sentiments", sentiments)):
        found = search.nearest_labels(new.select("url", "embedding"), labels, k=settings.classification_limit, id_col="url", label_col="id").withColumnRenamed("labels", name)
        new = new.join(found, "url", "left")
    return store.merge_partial(beans, new, ["url"])
