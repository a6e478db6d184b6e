"""Canonical articles, language, chunks and ranking over documents, embeddings and test items."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressroom.operators import hybrid, lexical, library, near, vectors
from suite import query
from suite.views import clean_sql, documents, table

CLEAN = clean_sql("text")
WORDS = f"list_filter(string_split(lower({CLEAN}), ' '), lambda w: w <> '')"


@query("b12_canonical_articles", """with recursive d as (select doc_id, text, case when doc_id % 10 < 2 then doc_id // 10 end as url_key from documents),
  e as (select a.doc_id as a, b.doc_id as b from d a join d b on a.text = b.text or a.url_key = b.url_key),
  reach(doc_id, other) as (select doc_id, doc_id from d union select r.doc_id, e.b from reach r join e on e.a = r.other)
  select doc_id, min(other) as canonical_id from reach group by 1""")
def canonical_articles(spark, sf_dir):
    """Documents of equal text, and pairs that share a URL, are one story."""
    url = F.when(F.col("doc_id") % 10 < 2, F.concat(F.lit("https://e.com/"), F.floor(F.col("doc_id") / 10)))
    d = documents(spark, sf_dir).select("doc_id", F.sha2("text", 256).alias("content_hash"), url.alias("url"))
    return library.canonical_articles(d, ["content_hash", "url"], "doc_id")


@query("b12_near_duplicate_articles", """with recursive d as (select doc_id, text, case when doc_id % 10 < 2 then doc_id // 10 end as url_key,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as ws from documents),
  s as (select doc_id, case when len(ws) = 0 then cast([] as varchar[]) when len(ws) < 4 then [array_to_string(ws, ' ')]
    else list_distinct([array_to_string(ws[i:i + 3], ' ') for i in range(1, len(ws) - 2)]) end as sh from d),
  g as (select doc_id, unnest(sh) as g from s),
  p as (select x.doc_id as a, y.doc_id as b, count(*) as n from g x join g y on x.g = y.g and x.doc_id < y.doc_id group by 1, 2),
  near as (select a, b from p join s x on x.doc_id = a join s y on y.doc_id = b where 100 * n >= 80 * (len(x.sh) + len(y.sh) - n)),
  e as (select a.doc_id as a, b.doc_id as b from d a join d b on a.text = b.text or a.url_key = b.url_key
    union select a, b from near union select b, a from near),
  reach(doc_id, other) as (select doc_id, doc_id from d union select r.doc_id, e.b from reach r join e on e.a = r.other)
  select doc_id, min(other) as canonical_id from reach group by 1""")
def near_duplicate_articles(spark, sf_dir):
    """The same with near duplicates: four-word shingles at a Jaccard similarity of 0.8 or more, verified."""
    url = F.when(F.col("doc_id") % 10 < 2, F.concat(F.lit("https://e.com/"), F.floor(F.col("doc_id") / 10)))
    d = documents(spark, sf_dir)
    keyed = d.select("doc_id", F.sha2("text", 256).alias("content_hash"), url.alias("url"))
    return library.canonical_articles(keyed, ["content_hash", "url"], "doc_id", near.near_links(d, "doc_id", "text", words=4, percent=80))


def _language_sql():
    counts = ", ".join(
        f"len(list_filter(w, lambda x: x in ({', '.join(repr(v) for v in listed)}))) as {name}" for name, listed in library.FUNCTION_WORDS.items())
    names = sorted(library.FUNCTION_WORDS)
    best = " ".join(f"when {n} = m then '{n}'" for n in names)
    return f"""with d as (select doc_id, {WORDS} as w from documents), c as (select doc_id, {counts} from d), t as (select *, greatest({', '.join(names)}) as m from c)
  select doc_id, case when coalesce(m, 0) = 0 then null {best} end as language from t"""


@query("b13_language_id", _language_sql())
def language_id(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", library.language_id("text").alias("language"))


@query("b14_chunk_articles", f"""with d as (select doc_id, string_split({CLEAN}, ' ') as w from documents where {CLEAN} is not null),
  s as (select doc_id, w, unnest(generate_series(0, greatest(len(w) - 41, 0), 160)) as first from d)
  select doc_id, cast(first // 160 as integer) as chunk_no, cast(len(w[first + 1:first + 200]) as integer) as n_words, array_to_string(w[first + 1:first + 200], ' ') as chunk from s""")
def chunk_articles(spark, sf_dir):
    return library.chunk_articles(documents(spark, sf_dir), 200, 40, "doc_id", "text")


BM25 = f"""d as (select doc_id, coalesce({WORDS}, []) as w from documents), n as (select count(*) as n_docs, avg(len(w)) as mean from d),
  q as (select item_id as query_id, unnest(list_distinct({WORDS})) as term from benchmark),
  p as (select doc_id, len(w) as n_words, unnest(w) as term from d),
  t as (select term, doc_id, count(*) as tf, any_value(n_words) as n_words from p where term in (select term from q) group by 1, 2),
  f as (select term, count(*) as df from t group by 1),
  s as (select term, doc_id, ln(1 + (n_docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * n_words / mean)) as part from t join f using (term), n),
  b as (select query_id, doc_id, round(sum(part), 6) as score from s join q using (term) group by 1, 2),
  lexical as (select query_id, cast(row_number() over (partition by query_id order by score desc, doc_id) as integer) as rank, doc_id, score from b)"""
COSINE = """v as (select vec_id, cast(embedding as double[]) as e from embeddings),
  c as (select a.vec_id as query_id, b.vec_id as doc_id, round(list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))), 6) as score from v a, v b where a.vec_id % 50 = 0),
  nearest as (select query_id, cast(row_number() over (partition by query_id order by score desc, doc_id) as integer) as rank, doc_id, score from c)"""


def _words(spark, sf_dir):
    queries = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return lexical.lexical_index(documents(spark, sf_dir), queries, article_id="doc_id", text="text")


def _vectors(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "doc_id")
    return rows, rows.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), "embedding")


@query("b15_bm25_search", f"with {BM25} select * from lexical where rank <= 10")
def bm25_search(spark, sf_dir):
    return lexical.search_lexical(_words(spark, sf_dir), 10)


@query("b16_vector_topk", f"with {COSINE} select * from nearest where rank <= 10")
def vector_topk(spark, sf_dir):
    rows, queries = _vectors(spark, sf_dir)
    return vectors.vector_topk(rows, queries, 10, article_id="doc_id")


@query("b16_vector_index_topk")
def vector_index_topk(spark, sf_dir):
    """A part of the lists only, as many as gave a recall of 0.95 on some of the queries."""
    rows, queries = _vectors(spark, sf_dir)
    index = vectors.build_index(rows, "doc_id")
    return vectors.search_index(index, queries, 10, probes=vectors.calibrated_probes(index, queries, 10, recall=0.95))


@query("b17_hybrid_rank", f"""with {BM25}, {COSINE},
  j as (select query_id, doc_id, l.rank as lexical_rank, n.rank as vector_rank from lexical l full join nearest n using (query_id, doc_id)),
  k as (select *, round(coalesce(1.0::double / (60 + lexical_rank), 0) + coalesce(1.0::double / (60 + vector_rank), 0), 9) as score from j),
  r as (select *, cast(row_number() over (partition by query_id order by score desc, doc_id) as integer) as rank from k) select * from r where rank <= 10""")
def hybrid_rank(spark, sf_dir):
    rows, queries = _vectors(spark, sf_dir)
    return hybrid.hybrid_search(_words(spark, sf_dir), vectors.build_index(rows, "doc_id"), queries, 10)
