"""Registered queries of the relational operators, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from gondola.functions.barcode import ean13_of_table, is_digits
from gondola.operators import audit, cdc, dedup, export, match, merge, reports
from gondola.plans.demo import cte, table
from gondola.plans.scalars import _read, _with_check
from gondola.schemas import RULES, violations


def numeric_products(spark, sf_dir):
    """Products with a numeric code, their brands' names, and the codes kept."""
    p, m, c = (table(spark, sf_dir, t) for t in ("produtos", "marcas", "codigos"))
    good = c.where(is_digits(F.col("codigo")))
    kept = p.join(good.select(F.col("produto_id").alias("id")), "id", "left_semi")
    brands = m.join(kept.select(F.col("marca_id").alias("id")), "id", "left_semi").select("id", F.lit("brand").alias("what"))
    codes = good.join(kept.select(F.col("id").alias("produto_id")), "produto_id", "left_semi").select("id", F.lit("code").alias("what"))
    none = p.join(good.select(F.col("produto_id").alias("id")), "id", "left_anti").select("id", F.lit("without").alias("what"))
    return kept.select("id", F.lit("product").alias("what")).unionByName(brands).unionByName(codes).unionByName(none)


NUMERIC_SQL = f"""{cte("produtos", "marcas", "codigos")}, good AS (SELECT * FROM codigos WHERE regexp_matches(codigo, '^[0-9]+$')), kept AS (SELECT * FROM produtos WHERE id IN (SELECT produto_id FROM good))
SELECT id, 'product' AS what FROM kept UNION ALL SELECT id, 'brand' FROM marcas WHERE id IN (SELECT marca_id FROM kept)
UNION ALL SELECT id, 'code' FROM good WHERE produto_id IN (SELECT id FROM kept) UNION ALL SELECT id, 'without' FROM produtos WHERE id NOT IN (SELECT produto_id FROM good)"""


def dedup_codes(spark, sf_dir):
    """First row of each code in each of two files; the later ones as conflicts."""
    c = table(spark, sf_dir, "codigos").withColumn("file", F.concat(F.lit("f"), (F.col("ordinal") % 2).cast("string")))
    kept, lost = dedup.codes_of_file(c)
    return kept.select("id", F.lit("kept").alias("what"), F.lit(None).cast("string").alias("message")).unionByName(lost.select("id", F.lit("lost").alias("what"), F.col("error_message").alias("message")))


DEDUP_SQL = f"""{cte("codigos")}, r AS (SELECT *, row_number() OVER (PARTITION BY ordinal % 2, trim(codigo) ORDER BY ordinal) AS n FROM codigos WHERE trim(codigo) <> '')
SELECT id, CASE WHEN n = 1 THEN 'kept' ELSE 'lost' END AS what, CASE WHEN n > 1 THEN concat('duplicate code in staging: ', trim(codigo)) END AS message FROM r"""


def dedup_lines(spark, sf_dir):
    """First, last and preferred line of each order, and its lines as text."""
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    code = F.when(F.col("l_partkey") % 3 == 0, F.concat(F.lit("789"), F.lpad(F.col("l_partkey").cast("string"), 10, "0"))).otherwise(F.col("l_partkey").cast("string"))
    held = F.collect_list(F.struct(order.alias("o"), F.concat(F.lit("P: "), F.col("l_partkey").cast("string")).alias("t")))
    text = F.sort_array(held)
    # parts are counted in the lines held: count_distinct would exchange each line twice, with all that is kept of its order
    return li.groupBy("l_orderkey").agg(
        dedup.first_value(F.col("l_partkey"), order).alias("first_part"),
        dedup.last_value(F.col("l_partkey"), order).alias("last_part"),
        dedup.preferred_code(code, order).alias("code"),
        F.array_join(F.transform(text, lambda x: x["t"]), " | ").alias("lines"),
        F.size(F.array_compact(F.array_distinct(held["o"]["l_partkey"]))).cast("long").alias("parts"),
    )


_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice"
LINES_SQL = f"""WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS n,
  CASE WHEN l_partkey % 3 = 0 THEN concat('789', lpad(CAST(l_partkey AS VARCHAR), 10, '0')) ELSE CAST(l_partkey AS VARCHAR) END AS code FROM lineitem)
SELECT l_orderkey, arg_min(l_partkey, n) AS first_part, arg_max(l_partkey, n) AS last_part, coalesce(arg_max(code, n) FILTER (length(code) = 13), arg_min(code, n)) AS code,
  string_agg(concat('P: ', l_partkey), ' | ' ORDER BY n) AS lines, count(DISTINCT l_partkey) AS parts FROM l GROUP BY 1"""


def dedup_key_chain(spark, sf_dir):
    """Keep-first by part, else supplier, else order, over three sources in turn; then keep-last by supplier."""
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    key = dedup.first_key(F.when(F.col("l_partkey") % 4 > 0, F.col("l_partkey").cast("string")), F.when(F.col("l_suppkey") % 3 > 0, F.concat(F.lit("s"), F.col("l_suppkey"))), F.concat(F.lit("o"), F.col("l_orderkey")))
    first = dedup.keep_first(li.withColumn("k", key), ["k"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    last = dedup.keep_last(li, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"])
    return first.select("k", "l_orderkey", "l_partkey").unionByName(last.select(F.concat(F.lit("last"), F.col("l_suppkey")).alias("k"), "l_orderkey", "l_partkey"))


CHAIN_SQL = """WITH l AS (SELECT *, CASE WHEN l_partkey % 4 > 0 THEN CAST(l_partkey AS VARCHAR) WHEN l_suppkey % 3 > 0 THEN concat('s', l_suppkey) ELSE concat('o', l_orderkey) END AS k FROM lineitem),
f AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n FROM l),
z AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) AS n FROM l)
SELECT k, l_orderkey, l_partkey FROM f WHERE n = 1 UNION ALL SELECT concat('last', l_suppkey), l_orderkey, l_partkey FROM z WHERE n = 1"""


def upsert_merge(spark, sf_dir):
    """Two snapshots of orders merged, then some deleted, some updated by condition, some from a table."""
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    old, new = o.where("o_orderkey % 3 <> 0"), o.where("o_orderkey % 5 <> 0").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    merged = merge.delete_ids(merge.upsert(old, new, "o_orderkey"), o.where("o_orderkey % 7 = 0"), "o_orderkey")
    merged = merge.update_where(merged, F.col("o_orderkey") % 11 == 0, {"o_orderstatus": F.lit("X")})
    return merge.update_from(merged, o.where("o_orderkey % 13 = 0").withColumn("o_orderstatus", F.lit(None).cast("string")), "o_orderkey", ["o_orderstatus"])


UPSERT_SQL = """WITH old AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0), new AS (SELECT o_orderkey, o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderkey % 5 <> 0),
m AS (SELECT * FROM new UNION ALL SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new))
SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM m WHERE o_orderkey % 7 <> 0"""


def upsert_codes(spark, sf_dir):
    """Codes of two files on top of stored ones: the last file owns a code."""
    c = table(spark, sf_dir, "codigos")
    stored = c.where("ordinal % 4 = 0").select("id", "produto_id", "codigo")
    stored = dedup.keep_first(stored, ["codigo"], ["id"])
    incoming = c.where("ordinal % 4 <> 0").withColumn("file", F.concat(F.lit("f"), (F.col("ordinal") % 3).cast("string")))
    return merge.upsert_codes(stored, incoming)


UPSERT_CODES_SQL = f"""{cte("codigos")}, s AS (SELECT id, produto_id, codigo FROM (SELECT *, row_number() OVER (PARTITION BY codigo ORDER BY id) AS n FROM codigos WHERE ordinal % 4 = 0) WHERE n = 1),
i AS (SELECT id, produto_id, codigo FROM (SELECT *, row_number() OVER (PARTITION BY codigo ORDER BY ordinal % 3 DESC, ordinal DESC) AS n FROM codigos WHERE ordinal % 4 <> 0) WHERE n = 1)
SELECT * FROM i UNION ALL SELECT * FROM s WHERE codigo NOT IN (SELECT codigo FROM i)"""


def repair_codes(spark, sf_dir):
    return merge.repair_codes(table(spark, sf_dir, "codigos"), ean13_of_table).select("id", "tipo", "codigo")


_H = "CASE WHEN length(e) < 12 THEN lpad(e, 12, '0') ELSE e END"
REPAIR_SQL = f"""{cte("codigos")}, a AS (SELECT *, regexp_replace(codigo, '[^0-9]', '', 'g') AS d FROM codigos), b AS (SELECT *, CASE WHEN length(d) = 13 AND (d LIKE '0789%' OR d LIKE '0790%') THEN substr(d, 2) ELSE d END AS e FROM a),
c AS (SELECT *, {_H} AS h FROM b), n AS (SELECT *, CASE WHEN tipo = 'EAN' AND length(codigo) <> 13 THEN CASE WHEN length(h) = 12 THEN {_with_check("h", 12)} ELSE h END END AS norm FROM c)
SELECT id, tipo, coalesce(norm, codigo) AS codigo FROM n WHERE norm IS NULL OR norm NOT IN (SELECT codigo FROM codigos WHERE tipo = 'EAN' AND length(codigo) = 13)"""


def reviewed_images(spark, sf_dir):
    p, a = table(spark, sf_dir, "produtos"), table(spark, sf_dir, "antes")
    return merge.keep_reviewed_images(p, a).select("id", "imagem_url", "status_imagem")


REVIEWED_SQL = f"""{cte("produtos", "antes")} SELECT p.id, CASE WHEN a.status_imagem IN ('aprovado', 'reprovado') THEN coalesce(nullif(a.imagem_url, ''), p.imagem_url) ELSE p.imagem_url END AS imagem_url,
 CASE WHEN a.status_imagem IN ('aprovado', 'reprovado') THEN a.status_imagem ELSE p.status_imagem END AS status_imagem FROM produtos p LEFT JOIN antes a ON p.id = a.id"""


def new_products(spark, sf_dir):
    p, m, c, a = (table(spark, sf_dir, t) for t in ("produtos", "marcas", "codigos", "antes"))
    return cdc.logged(cdc.new_rows(p, a), m, c).select("id", "marca", "ean", "dun", F.coalesce("descricao_padronizada", "descricao_original").alias("descricao"), "classe")


NEW_SQL = f"""{cte("produtos", "marcas", "codigos", "antes")}, l AS (SELECT produto_id, arg_max(tipo, ordinal) AS tipo, arg_max(codigo, ordinal) AS codigo FROM codigos GROUP BY 1)
SELECT p.id, coalesce(m.nome, 'N/D') AS marca, coalesce(l.codigo, '') AS ean, CASE WHEN l.tipo = 'DUN' THEN l.codigo ELSE '' END AS dun, coalesce(descricao_padronizada, descricao_original) AS descricao, classe
FROM produtos p LEFT JOIN marcas m ON p.marca_id = m.id LEFT JOIN l ON l.produto_id = p.id WHERE p.id NOT IN (SELECT id FROM antes)"""


def field_diff(spark, sf_dir):
    changes = cdc.field_changes(table(spark, sf_dir, "produtos"), table(spark, sf_dir, "antes"))
    return changes.select("id", F.inline("alteracoes"))


def _text_diff(field: str, label: str, empty: str) -> str:
    old, new = f"trim(coalesce(a.{field}, ''))", f"trim(coalesce(p.{field}, ''))"
    return f"SELECT p.id, '{label}' AS campo, coalesce(nullif({old}, ''), '{empty}') AS de, coalesce(nullif({new}, ''), '{empty}') AS para FROM produtos p JOIN antes a ON p.id = a.id WHERE {old} <> {new}"


DIFF_SQL = cte("produtos", "antes") + " UNION ALL ".join(
    [_text_diff(*f) for f in [*cdc.TEXT_FIELDS, cdc.BRAND_FIELD]]
    + ["SELECT p.id, 'Peso (g)', coalesce(CAST(a.peso_gramas AS VARCHAR), 'N/D'), coalesce(CAST(p.peso_gramas AS VARCHAR), 'N/D') FROM produtos p JOIN antes a ON p.id = a.id WHERE a.peso_gramas IS DISTINCT FROM p.peso_gramas"]
    + ["SELECT p.id, 'Fracionado', CAST(a.fracionado AS VARCHAR), CAST(p.fracionado AS VARCHAR) FROM produtos p JOIN antes a ON p.id = a.id WHERE a.fracionado <> p.fracionado"]
)


def two_key_match(spark, sf_dir):
    """Customers matched to suppliers by a synthetic code, else by balance class."""
    cu = _read(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey") % 50).alias("code"), (F.col("c_custkey") % 17).alias("name"))
    su = _read(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 40).alias("code"), (F.col("s_suppkey") % 23).alias("name"), "s_suppkey")
    return match.priority_match(cu, su, [(cu.code, su.code), (cu.name, su.name)], "s_suppkey", ["s_suppkey"]).select("c_custkey", "match_s_suppkey")


TWO_KEY_SQL = """WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 50 END AS code, c_custkey % 17 AS name FROM customer)
SELECT c_custkey, coalesce((SELECT max(s_suppkey) FROM supplier WHERE s_suppkey % 40 = c.code), (SELECT max(s_suppkey) FROM supplier WHERE s_suppkey % 23 = c.name)) AS match_s_suppkey FROM c"""


def merge_pages(spark, sf_dir):
    """All parts as products, overlaid with a page each: some known by EAN, some by title, some new."""
    pa = _read(spark, sf_dir, "part")
    name = F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey"))
    products = pa.select(F.col("p_partkey").cast("string").alias("sku"), F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("789"), F.col("p_partkey"))).otherwise("").alias("ean"), name.alias("title"), F.lit("old").alias("image_url"))
    title = F.when(F.col("p_partkey") % 2 == 0, F.upper(name)).otherwise(F.concat(F.lit("New "), name))
    pages = pa.select(F.when(F.col("p_partkey") % 5 > 0, F.concat(F.lit("789"), F.col("p_partkey"))).otherwise("").alias("ean"), title.alias("title"), F.concat(F.lit("new"), F.col("p_partkey")).alias("image_url"), F.col("p_partkey").alias("ordinal"))
    return match.merge_pages(products, pages)


MERGE_PAGES_SQL = """WITH p AS (SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS sku, CASE WHEN p_partkey % 4 = 0 THEN concat('789', p_partkey) ELSE '' END AS ean, concat(p_name, ' ', p_partkey) AS title FROM part),
g AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 5 > 0 THEN concat('789', p_partkey) ELSE '' END AS ean, concat('New ', p_name, ' ', p_partkey) AS title, concat('new', p_partkey) AS image_url FROM part)
SELECT sku, nullif(coalesce(nullif(p.ean, ''), g.ean), '') AS ean, p.title, coalesce(g.image_url, 'old') AS image_url FROM p LEFT JOIN g ON p.k = g.k AND p.k % 2 = 0
UNION ALL SELECT concat('INST_', ean), ean, title, image_url FROM g WHERE ean <> '' AND k % 2 <> 0"""


def image_match(spark, sf_dir):
    """All parts as products against all parts as images."""
    pa = _read(spark, sf_dir, "part")
    word = F.lower(F.regexp_replace("p_name", " ", "-"))
    products = pa.select(F.col("p_partkey").alias("id"), F.concat(F.lit("sku"), F.col("p_partkey")).alias("sku"), F.concat(F.col("p_name"), F.when(F.col("p_partkey") % 3 == 0, F.lit(" Peito 1 kg")).otherwise("")).alias("title"))
    images = pa.select(F.concat(F.lit("https://a.example/produto/"), word, F.when(F.col("p_partkey") % 2 == 0, F.lit("-peito-1kg")).otherwise(""), F.lit("/")).alias("url"), F.concat(F.lit("https://a.example/img/x_sku"), F.col("p_partkey") * 2, F.lit(".png")).alias("image_url"), F.col("p_partkey").alias("ordinal"))
    return match.image_match(products, images)


IMAGE_MATCH_SQL = """WITH p AS (SELECT p_partkey AS id, concat(lower(p_name), CASE WHEN p_partkey % 3 = 0 THEN ' peito 1 kg' ELSE '' END) AS title, p_partkey % 3 = 0 AS peito FROM part),
i AS (SELECT p_partkey AS o, concat(lower(p_name), CASE WHEN p_partkey % 2 = 0 THEN ' peito 1kg' ELSE '' END) AS words, p_partkey % 2 = 0 AS peito, concat('https://a.example/img/x_sku', p_partkey * 2, '.png') AS image_url FROM part),
e AS (SELECT id, arg_min(image_url, o) AS u FROM p JOIN i ON starts_with(CAST(o * 2 AS VARCHAR), CAST(id AS VARCHAR)) GROUP BY id),
s AS (SELECT id, o, image_url, len(list_intersect(list_distinct(string_split(title, ' ')), list_distinct(string_split(words, ' ')))) AS n FROM p JOIN i ON p.peito = i.peito),
b AS (SELECT id, arg_min(image_url, o - n * 1000000) AS u FROM s WHERE n >= 2 GROUP BY id)
SELECT p.id, coalesce(e.u, b.u) AS image_url FROM p LEFT JOIN e ON p.id = e.id LEFT JOIN b ON p.id = b.id"""


def overlap_match(spark, sf_dir):
    """Each part's nearest other part by words."""
    words = F.split(F.concat("p_name", F.lit(" "), "p_type"), " ")
    parts = _read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), words.alias("words"), F.col("p_partkey").alias("ordinal"))
    return match.best_by_words(parts, parts, not_itself=True)


OVERLAP_SQL = """WITH w AS (SELECT DISTINCT p_partkey AS id, unnest(string_split(concat(p_name, ' ', p_type), ' ')) AS w FROM part),
s AS (SELECT a.id, b.id AS match_id, count(*) AS score FROM w a JOIN w b ON a.w = b.w AND a.id <> b.id GROUP BY 1, 2 HAVING count(*) >= 2)
SELECT id, arg_max(match_id, score * 100000000 - match_id) AS match_id, max(score) AS score FROM s GROUP BY id"""


def range_join(spark, sf_dir):
    """Events of a value less than 0.055 above another's, on the same event type."""
    e = _read(spark, sf_dir, "events").select("event_id", "event_type", "value")
    marks = e.select(F.col("event_id").alias("mark_id"), "event_type", F.col("value").alias("mark"))
    return match.band_join(e, marks, ["event_type"], F.col("mark"), F.col("mark") + 0.055, F.col("value"), 0.055, ["event_id"]).select("mark_id", "event_id")


RANGE_SQL = """SELECT m.event_id AS mark_id, e.event_id FROM events e JOIN events m ON e.event_type = m.event_type AND e.value > m.value AND e.value < m.value + 0.055"""


def audit_rules(spark, sf_dir):
    return audit.audit(table(spark, sf_dir, "produtos"), table(spark, sf_dir, "codigos"))


_CODE = "SELECT '{0}' AS category, '{1}' AS severity, id AS item_id, {3} AS details FROM n WHERE {2}"
_BAR = "tipo IN ('EAN', 'EAN-13', 'EAN-8', 'DUN', 'DUN-14')"
AUDIT_SQL = f"""{cte("produtos", "codigos")}, n AS (SELECT *, row_number() OVER (PARTITION BY trim(codigo) ORDER BY ordinal) AS nth, first_value(produto_id) OVER (PARTITION BY trim(codigo) ORDER BY ordinal) AS f FROM codigos),
h AS (SELECT produto_id, bool_or(upper(tipo) LIKE '%EAN%' AND regexp_matches(codigo, '^[0-9]+$')) AS ean, string_agg(concat(tipo, ':', codigo), ', ' ORDER BY ordinal) AS c FROM codigos GROUP BY 1)
SELECT 'PRODUTO_SEM_CODIGO' AS category, 'CRITICAL' AS severity, id AS item_id, concat('Produto "', descricao_original, '" (', id, ') não possui NENHUM código de barras cadastrado.') AS details FROM produtos WHERE id NOT IN (SELECT produto_id FROM h)
UNION ALL SELECT 'PRODUTO_SEM_EAN_NUMERICO', 'CRITICAL', produto_id, concat('Produto "', descricao_original, '" (', id, ') possui códigos [', c, '], mas NENHUM EAN numérico válido!') FROM h JOIN produtos ON id = produto_id WHERE NOT ean
UNION ALL SELECT 'DESCRICAO_INVALIDA', 'WARNING', id, concat('descricao_padronizada não é uma string válida: ', CASE WHEN descricao_padronizada = '' THEN '""' ELSE 'null' END) FROM produtos WHERE coalesce(descricao_padronizada, '') = ''
UNION ALL SELECT 'OBJECT_OBJECT_LEAK', 'CRITICAL', id, concat('descricao_padronizada contém a string corrompida "[object Object]": "', descricao_padronizada, '"') FROM produtos WHERE contains(descricao_padronizada, '[object Object]')
UNION ALL SELECT 'PESO_GRAMAS_ANOMALO', 'WARNING', id, concat('peso_gramas tem valor anormal: ', peso_gramas) FROM produtos WHERE peso_gramas <= 0
UNION ALL {_CODE.format("CODIGO_DUPLICADO", "CRITICAL", "nth > 1", """concat('Código "', codigo, '" está duplicado entre produto ', produto_id, ' e produto ', f, '.')""")}
UNION ALL {_CODE.format("EAN_NAO_NUMERICO", "CRITICAL", _BAR + " AND NOT regexp_matches(codigo, '^[0-9]+$')", """concat('Código de barras tipo "', tipo, '" contém caracteres não-numéricos: "', codigo, '" (produto_id: ', produto_id, ')')""")}
UNION ALL {_CODE.format("EAN_TAMANHO_INVALIDO", "WARNING", _BAR + " AND regexp_matches(codigo, '^[0-9]+$') AND length(codigo) NOT BETWEEN 8 AND 14", """concat('Código de barras tipo "', tipo, '" tem tamanho fora do padrão (', length(codigo), ' dígitos): "', codigo, '" (produto_id: ', produto_id, ')')""")}
UNION ALL {_CODE.format("SLUG_LEAK_EM_CODIGO", "CRITICAL", "regexp_matches(codigo, '^[a-zA-Z_]') AND tipo <> 'SKU'", """concat('Código marcado como ', tipo, ' é uma string alfanumérica/slug: "', codigo, '"')""")}"""


def audit_summary(spark, sf_dir):
    return audit_rules(spark, sf_dir).groupBy("severity").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("category").alias("categories"))


AUDIT_SUMMARY_SQL = f"SELECT severity, count(*) AS n, count(DISTINCT category) AS categories FROM ({AUDIT_SQL}) GROUP BY 1"


def sanitise_pass(spark, sf_dir):
    p, c = audit.sanitise(table(spark, sf_dir, "produtos"), table(spark, sf_dir, "codigos"))
    return p.select("id", F.col("imagem_url").alias("value"), "status_imagem").unionByName(c.select("id", F.col("codigo").alias("value"), F.lit(None).cast("string").alias("status_imagem")))


SANITISE_SQL = f"""{cte("produtos", "codigos")}, g AS (SELECT * FROM codigos WHERE regexp_matches(codigo, '^[0-9]+$'))
SELECT id, CASE WHEN contains(imagem_url, 'placeholder') OR contains(imagem_url, 'force.com') THEN NULL ELSE imagem_url END AS value,
 CASE WHEN contains(imagem_url, 'placeholder') OR contains(imagem_url, 'force.com') THEN 'sem_imagem' ELSE status_imagem END AS status_imagem FROM produtos WHERE id IN (SELECT produto_id FROM g)
UNION ALL SELECT id, codigo, NULL FROM g"""


def manifest_rules(spark, sf_dir):
    return violations(table(spark, sf_dir, "produtos"), "produtos").unionByName(violations(table(spark, sf_dir, "codigos"), "codigos_barras"))


def _rules_sql(table_name: str, rules: str) -> str:
    return " UNION ALL ".join(f"SELECT id, '{rule}' AS rule FROM {table_name} WHERE NOT coalesce({cond}, false)" for rule, cond in RULES[rules])


RULES_SQL = cte("produtos", "codigos") + _rules_sql("produtos", "produtos") + " UNION ALL " + _rules_sql("codigos", "codigos_barras")


def unique_codes(spark, sf_dir):
    return audit.duplicate_keys(table(spark, sf_dir, "codigos"), ["codigo", "tipo"])


UNIQUE_SQL = f"{cte('codigos')} SELECT codigo, tipo, count(*) AS n FROM codigos GROUP BY 1, 2 HAVING count(*) > 1"


def tenant_rows(spark, sf_dir):
    n = _read(spark, sf_dir, "nation").withColumn("empresa_id", F.concat(F.lit("t"), F.col("n_regionkey")))
    people = _read(spark, sf_dir, "customer").select(F.col("c_name").alias("id"), F.concat(F.lit("t"), F.col("c_nationkey") % 5).alias("empresa_id"))
    users = people.select("id", F.concat(F.col("id"), F.lit("@x.example")).alias("email"), F.when(F.col("id").endswith("1"), F.lit('{"role":"admin","nome":"N"}')).otherwise("{}").alias("meta"))
    made = audit.profiles_of_users(users).select(F.concat_ws("/", "id", "nome", "role").alias("name"), F.lit("made").alias("what"))
    mine = audit.tenant_view(n, "t1").select(F.col("n_name").alias("name"), F.lit("mine").alias("what"))
    every = audit.tenant_view(n, None, superadmin=True).select(F.col("n_name").alias("name"), F.lit("all").alias("what"))
    tag = lambda df, what: df.select(F.col("n_name").alias("name"), F.lit(what).alias("what"))
    seen = tag(audit.catalogue_view(n, True), "read").unionByName(tag(audit.catalogue_view(n, False), "anonymous"))
    renamed = n.where("n_nationkey < 3").withColumn("n_name", F.lower("n_name"))
    written = tag(audit.catalogue_write(n, renamed, True, "n_nationkey"), "written").unionByName(tag(audit.catalogue_write(n, renamed, False, "n_nationkey"), "refused"))
    edit = audit.may_update_profile(people, "none", "t2", "admin").select(F.col("id").alias("name"), F.lit("edit").alias("what"))
    return mine.unionByName(every).unionByName(edit).unionByName(made).unionByName(seen).unionByName(written)


TENANT_SQL = """SELECT n_name AS name, 'mine' AS what FROM nation WHERE n_regionkey = 1 UNION ALL SELECT n_name, 'all' FROM nation UNION ALL SELECT c_name, 'edit' FROM customer WHERE c_nationkey % 5 = 2
UNION ALL SELECT CASE WHEN c_name LIKE '%1' THEN concat(c_name, '/N/admin') ELSE concat(c_name, '/', c_name, '/operador') END, 'made' FROM customer
UNION ALL SELECT n_name, 'read' FROM nation UNION ALL SELECT CASE WHEN n_nationkey < 3 THEN lower(n_name) ELSE n_name END, 'written' FROM nation UNION ALL SELECT n_name, 'refused' FROM nation"""


def export_catalogue(spark, sf_dir):
    p, m, c = (table(spark, sf_dir, t) for t in ("produtos", "marcas", "codigos"))
    files = _read(spark, sf_dir, "part").select(F.concat(F.lit("/img/790"), F.lpad(F.col("p_partkey").cast("string"), 10, "0"), F.lit(".webp")).alias("path"), (F.col("p_partkey") % 3 * 600).alias("length"))
    held = {"criado_em": F.concat(F.lit("2024-01-"), F.lpad((F.col("ordinal") % 28 + 1).cast("string"), 2, "0")), "codigo": F.when(F.col("ordinal") % 3 == 0, F.col("classe")).when(F.col("ordinal") % 3 == 1, F.lit(""))}
    held["pesar_cod"] = F.when(F.col("ordinal") % 2 == 0, F.lit("P"))
    return export.with_aliases(export.catalogue(p.withColumns(held), m, c, files)).withColumn("peso_gramas", F.col("peso_gramas").cast("string"))


EXPORT_SQL = f"""{cte("produtos", "marcas", "codigos")}, k AS (SELECT *, CASE WHEN regexp_matches(codigo, '^[0-9]{{14}}$') THEN 'DUN' WHEN upper(tipo) LIKE '%DUN%' AND regexp_matches(codigo, '^[0-9]+$') THEN NULL
  WHEN regexp_matches(codigo, '^[0-9]{{13}}$') AND upper(tipo) NOT LIKE '%SKU%' THEN 'EAN' WHEN upper(tipo) LIKE '%SKU%' OR length(codigo) < 13 THEN 'SKU' END AS kind FROM codigos),
b AS (SELECT produto_id, arg_max(codigo, ordinal) FILTER (kind = 'EAN') AS ean, arg_max(codigo, ordinal) FILTER (kind = 'DUN') AS dun FROM k GROUP BY 1),
f AS (SELECT concat('790', lpad(CAST(p_partkey AS VARCHAR), 10, '0')) AS ean FROM part WHERE p_partkey % 3 * 600 > 1000),
r AS (SELECT p.*, b.ean, b.dun, m.nome, f.ean IS NOT NULL AS loc, contains(lower(imagem_url), 'force.com') OR contains(lower(imagem_url), 'placeholder') AS bad FROM produtos p JOIN b ON b.produto_id = p.id AND b.ean IS NOT NULL LEFT JOIN marcas m ON m.id = p.marca_id LEFT JOIN f ON f.ean = b.ean),
s AS (SELECT *, CASE WHEN bad THEN 'sem_imagem' ELSE coalesce(status_imagem, 'sem_imagem') END AS st FROM r),
t AS (SELECT *, CASE WHEN st = 'sem_imagem' THEN NULL WHEN loc THEN concat('/imagens_produtos/', ean, '.webp') WHEN coalesce(imagem_url, '') = '' OR st = 'pendente_aprovacao' THEN NULL ELSE imagem_url END AS img,
  CASE WHEN st = 'sem_imagem' THEN st WHEN loc THEN st WHEN coalesce(imagem_url, '') = '' OR st = 'pendente_aprovacao' THEN 'sem_imagem' ELSE st END AS stat, coalesce(descricao_padronizada, descricao_original) AS descr FROM s)
SELECT id, marca_id AS "marcaId", coalesce(nome, 'N/D') AS "marcaDescr", classe AS "produtoClasse", ean AS "produtoEan", coalesce(dun, '') AS "produtoDun", conservacao AS "produtoConservacao", descr AS "produtoDescr", CAST(peso_gramas AS VARCHAR) AS peso_gramas, fracionado,
 img AS "imagemUrl", stat AS "statusImagem", coalesce(nome, 'N/D') AS "marcaNome", coalesce(nome, 'N/D') AS marca_nome, ean AS sku, descr AS title, descr AS descricao, img AS imagem_url, stat AS status_imagem,
 CASE WHEN ordinal % 3 = 0 THEN classe WHEN ordinal % 2 = 0 THEN 'P' ELSE '' END AS "pesarCod", concat('2024-01-', lpad(CAST(ordinal % 28 + 1 AS VARCHAR), 2, '0')) AS criado_em, concat('2024-01-', lpad(CAST(ordinal % 28 + 1 AS VARCHAR), 2, '0')) AS "criadoEm" FROM t"""


def unpivot_codes(spark, sf_dir):
    pa = _read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_partkey").cast("string").alias("sku"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).alias("ean"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_type")).otherwise("").alias("dun"))
    return export.unpivot_codes(pa).withColumn("tipo", export.kind_of(F.concat(F.lit(" x"), F.lower("tipo"))))


UNPIVOT_SQL = """SELECT p_partkey AS id, 'xsku' AS tipo, CAST(p_partkey AS VARCHAR) AS codigo, 'Unidade' AS embalagem, 1 AS quantidade_embalagem FROM part
UNION ALL SELECT p_partkey, 'EAN', p_brand, 'Unidade', 1 FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, 'DUN', p_type, 'Caixa', 1 FROM part WHERE p_partkey % 3 = 0"""


def sheet_rows(spark, sf_dir):
    return export.sheet_rows(*(table(spark, sf_dir, t) for t in ("produtos", "marcas", "codigos")))


SHEET_SQL = f"""{cte("produtos", "marcas", "codigos")}, l AS (SELECT produto_id, string_agg(concat(tipo, ': ', codigo), ' | ' ORDER BY ordinal) AS c FROM codigos GROUP BY 1)
SELECT p.id, coalesce(nome, 'N/D') AS marca, coalesce(nullif(descricao_padronizada, ''), nullif(descricao_original, ''), 'N/D') AS descricao,
 coalesce(CASE WHEN peso_gramas >= 1000 THEN concat(replace(rtrim(rtrim(printf('%.3f', peso_gramas / 1000.0), '0'), '.'), '.', ','), 'kg') WHEN peso_gramas IS NOT NULL THEN concat(peso_gramas, 'g') END, 'Variável') AS peso,
 CASE WHEN fracionado THEN 'Sim' ELSE 'Não' END AS fracionado, coalesce(l.c, 'Sem código') AS codigos FROM produtos p LEFT JOIN marcas m ON m.id = p.marca_id LEFT JOIN l ON l.produto_id = p.id"""


def code_sheet(spark, sf_dir):
    packed = table(spark, sf_dir, "codigos").withColumns({"embalagem": F.when(F.col("tipo") == "DUN-14", F.lit("Caixa")), "quantidade_embalagem": F.when(F.col("ordinal") % 2 == 0, F.lit(12))})
    return export.code_rows(table(spark, sf_dir, "produtos"), packed)


CODE_SHEET_SQL = f"""{cte("produtos", "codigos")} SELECT c.id, produto_id, coalesce(descricao_padronizada, '') AS produto, tipo, codigo, CASE WHEN tipo = 'DUN-14' THEN 'Caixa' ELSE '' END AS embalagem,
 CASE WHEN c.ordinal % 2 = 0 THEN '12' ELSE '' END AS quantidade_embalagem, '' AS criado_em FROM codigos c LEFT JOIN produtos p ON p.id = produto_id"""


def image_subset(spark, sf_dir):
    """Exported products of some brands that have an image."""
    files = _read(spark, sf_dir, "part").where("p_partkey % 7 = 6").select(F.concat(F.lit("/x/790"), F.lpad(F.col("p_partkey").cast("string"), 10, "0"), F.lit(".webp")).alias("path"))
    shown = F.when(F.col("id").rlike("[13579]$"), F.concat(F.lit("https://cdn.example.com/"), "id"))
    return export.image_subset(export_catalogue(spark, sf_dir).withColumn("imagemUrl", shown), files, ["_1", "_7", "_24"], "Family")


IMAGE_SUBSET_SQL = f"""WITH e AS ({EXPORT_SQL}), f AS (SELECT concat('790', lpad(CAST(p_partkey AS VARCHAR), 10, '0')) AS ean FROM part WHERE p_partkey % 7 = 6),
j AS (SELECT e.*, f.ean IS NOT NULL AS loc, CASE WHEN regexp_matches(e.id, '[13579]$') THEN concat('https://cdn.example.com/', e.id) ELSE '' END AS u FROM e LEFT JOIN f ON f.ean = "produtoEan" WHERE regexp_matches(lower("marcaDescr"), '_1|_7|_24'))
SELECT id, "produtoEan" AS ean, coalesce(nullif("produtoDun", ''), 'N/D') AS dun, "marcaDescr" AS marca, coalesce(nullif("produtoDescr", ''), 'N/D') AS descricao, coalesce(nullif("produtoClasse", ''), 'Industrializados') AS classe, "produtoConservacao" AS conservacao,
 CASE WHEN loc THEN concat('/imagens_produtos/', "produtoEan", '.webp') ELSE u END AS imagem, 'VALIDATED' AS status, CASE WHEN loc THEN 'WebP Local (0ms offline)' ELSE 'URL Web Oficial' END AS origem FROM j WHERE loc OR u LIKE 'http%'"""


def image_sources(spark, sf_dir):
    pa = _read(spark, sf_dir, "part")
    s = lambda m, r, text: F.when(F.col("p_partkey") % m == r, F.concat(F.lit(text), F.col("p_partkey")))
    out = export.image_source(s(5, 0, "/l/"), F.coalesce(s(3, 1, "http://d/"), s(3, 2, "ftp://d/")), s(7, 3, "http://s/"), s(2, 0, "pdf"))
    return pa.select("p_partkey", out.alias("i")).select("p_partkey", "i.imagem_url", "i.status_imagem")


IMAGE_SOURCES_SQL = """SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN concat('/l/', p_partkey) WHEN p_partkey % 3 = 1 THEN concat('http://d/', p_partkey) WHEN p_partkey % 7 = 3 THEN concat('http://s/', p_partkey) WHEN p_partkey % 2 = 0 THEN concat('pdf', p_partkey) END AS imagem_url,
 CASE WHEN p_partkey % 5 = 0 OR p_partkey % 3 = 1 OR p_partkey % 7 = 3 THEN 'VALIDATED' WHEN p_partkey % 2 = 0 THEN 'PDF_EXTRACTED' ELSE 'SEM_IMAGEM' END AS status_imagem FROM part"""


def filters(spark, sf_dir):
    """Pushed-down predicates: equality, inequality, null tests, lists, disjunction, case-insensitive likeness."""
    p = table(spark, sf_dir, "produtos")
    pick = lambda what, cond: p.where(cond).select("id", F.lit(what).alias("what"))
    out = pick("eq", F.col("status_imagem") == "aprovado")
    for what, cond in {
        "neq": F.col("status_imagem") != "aprovado",
        "not_null": F.col("imagem_url").isNotNull(),
        "in": F.col("marca_id").isin("marca_1", "marca_2"),
        "or": (F.col("status_imagem") == "sem_imagem") | F.col("status_imagem").isNull() | (F.col("imagem_url") == ""),
        "ilike": F.col("classe").ilike("%steel%"),
    }.items():
        out = out.unionByName(pick(what, cond))
    return out


FILTERS_SQL = cte("produtos") + " UNION ALL ".join(
    f"SELECT id, '{what}' AS what FROM produtos WHERE {cond}"
    for what, cond in {
        "eq": "status_imagem = 'aprovado'",
        "neq": "status_imagem <> 'aprovado'",
        "not_null": "imagem_url IS NOT NULL",
        "in": "marca_id IN ('marca_1', 'marca_2')",
        "or": "status_imagem = 'sem_imagem' OR status_imagem IS NULL OR imagem_url = ''",
        "ilike": "classe ILIKE '%steel%'",
    }.items()
)


def set_operations(spark, sf_dir):
    c, o = _read(spark, sf_dir, "customer"), _read(spark, sf_dir, "orders")
    all_, some = c.select(F.col("c_custkey").alias("k")), o.select(F.col("o_custkey").alias("k"))
    tag = lambda d, what: d.select("k", F.lit(what).alias("what"))
    fresh = all_.where("k % 2 = 0").unionByName(all_.where("k % 3 = 0").join(all_.where("k % 2 = 0"), "k", "left_anti"))
    return tag(all_.join(some, "k", "left_anti"), "minus").unionByName(tag(all_.join(some, "k", "left_semi"), "both")).unionByName(tag(fresh, "union")).unionByName(tag(some.distinct(), "distinct"))


SET_SQL = """SELECT c_custkey AS k, 'minus' AS what FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT c_custkey, 'both' FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
UNION ALL SELECT c_custkey, 'union' FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0 UNION ALL SELECT DISTINCT o_custkey, 'distinct' FROM orders"""


def chained_lookup(spark, sf_dir):
    """Brand by likeness -> products -> barcodes, by chained semi joins."""
    m, p, c = (table(spark, sf_dir, t) for t in ("marcas", "produtos", "codigos"))
    picked = p.join(m.where(F.col("nome").ilike("%1%")).select(F.col("id").alias("marca_id")), "marca_id", "left_semi")
    return c.join(picked.select(F.col("id").alias("produto_id")), "produto_id", "left_semi").select("id", "codigo")


CHAINED_SQL = f"{cte('marcas', 'produtos', 'codigos')} SELECT id, codigo FROM codigos WHERE produto_id IN (SELECT id FROM produtos WHERE marca_id IN (SELECT id FROM marcas WHERE nome ILIKE '%1%'))"


def nested_record(spark, sf_dir):
    """Given codes with product, brand and holding nested, as JSON."""
    f, m, p, c = (table(spark, sf_dir, t) for t in ("fabricantes", "marcas", "produtos", "codigos"))
    rows = c.where(F.col("codigo").isin("1", "12", "7900000000006", "7900000000007", "x3"))
    rows = rows.join(p.select(F.col("id").alias("produto_id"), F.struct("id", "descricao_original").alias("produto"), "marca_id"), "produto_id", "left")
    rows = rows.join(m.select(F.col("id").alias("marca_id"), F.col("nome").alias("marca"), "fabricante_id"), "marca_id", "left")
    rows = rows.join(f.select(F.col("id").alias("fabricante_id"), F.col("nome").alias("fabricante")), "fabricante_id", "left")
    return rows.select("id", F.to_json(F.struct("codigo", "produto", F.struct(F.col("marca").alias("nome"), "fabricante").alias("marca"))).alias("record"))


NESTED_SQL = f"""{cte("fabricantes", "marcas", "produtos", "codigos")} SELECT c.id, concat('{{"codigo":"', codigo, '","produto":{{"id":"', p.id, '","descricao_original":"', descricao_original, '"}},"marca":{{',
 CASE WHEN m.nome IS NOT NULL THEN concat('"nome":"', m.nome, '","fabricante":"', f.nome, '"') ELSE '' END, '}}}}') AS record
FROM codigos c LEFT JOIN produtos p ON p.id = c.produto_id LEFT JOIN marcas m ON m.id = p.marca_id LEFT JOIN fabricantes f ON f.id = m.fabricante_id WHERE codigo IN ('1', '12', '7900000000006', '7900000000007', 'x3')"""


def numbered_pending(spark, sf_dir):
    """Numbered list of the products whose image waits, by id."""
    p = table(spark, sf_dir, "produtos").where("status_imagem = 'pendente_aprovacao'")
    return reports.numbered(p, F.substring("id", 1, 6), "ordinal", "item", step=100).select("id", "item", F.substring("id", 1, 6).alias("grupo"))


PENDING_SQL = f"{cte('produtos')} SELECT id, CAST(row_number() OVER (PARTITION BY substr(id, 1, 6) ORDER BY ordinal) AS INTEGER) AS item, substr(id, 1, 6) AS grupo FROM produtos WHERE status_imagem = 'pendente_aprovacao'"

QUERIES = {
    "numeric_products": (numeric_products, NUMERIC_SQL),
    "dedup_codes": (dedup_codes, DEDUP_SQL),
    "dedup_lines": (dedup_lines, LINES_SQL),
    "dedup_key_chain": (dedup_key_chain, CHAIN_SQL),
    "upsert_merge": (upsert_merge, UPSERT_SQL),
    "upsert_codes": (upsert_codes, UPSERT_CODES_SQL),
    "repair_codes": (repair_codes, REPAIR_SQL),
    "reviewed_images": (reviewed_images, REVIEWED_SQL),
    "new_products": (new_products, NEW_SQL),
    "field_diff": (field_diff, DIFF_SQL),
    "two_key_match": (two_key_match, TWO_KEY_SQL),
    "merge_pages": (merge_pages, MERGE_PAGES_SQL),
    "image_match": (image_match, IMAGE_MATCH_SQL),
    "overlap_match": (overlap_match, OVERLAP_SQL),
    "range_join": (range_join, RANGE_SQL),
    "audit_rules": (audit_rules, AUDIT_SQL),
    "audit_summary": (audit_summary, AUDIT_SUMMARY_SQL),
    "sanitise_pass": (sanitise_pass, SANITISE_SQL),
    "manifest_rules": (manifest_rules, RULES_SQL),
    "unique_codes": (unique_codes, UNIQUE_SQL),
    "tenant_rows": (tenant_rows, TENANT_SQL),
    "export_catalogue": (export_catalogue, EXPORT_SQL),
    "unpivot_codes": (unpivot_codes, UNPIVOT_SQL),
    "sheet_rows": (sheet_rows, SHEET_SQL),
    "code_sheet": (code_sheet, CODE_SHEET_SQL),
    "image_subset": (image_subset, IMAGE_SUBSET_SQL),
    "image_sources": (image_sources, IMAGE_SOURCES_SQL),
    "filters": (filters, FILTERS_SQL),
    "set_operations": (set_operations, SET_SQL),
    "chained_lookup": (chained_lookup, CHAINED_SQL),
    "nested_record": (nested_record, NESTED_SQL),
    "numbered_pending": (numbered_pending, PENDING_SQL),
}
