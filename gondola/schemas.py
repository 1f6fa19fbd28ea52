"""Schemas of the catalogue and the rules its rows must meet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOLDINGS = "id string, nome string, cnpj string, site_oficial string, ativo boolean, criado_em timestamp"
BRANDS = "id string, fabricante_id string, nome string, slug string, descricao string, ativo boolean, criado_em timestamp"
PRODUCTS = (
    "id string, marca_id string, descricao_padronizada string, descricao_original string, classe string, conservacao string,"
    " peso_gramas bigint, fracionado boolean, imagem_url string, status_imagem string, criado_em timestamp"
)
BARCODES = "id string, produto_id string, tipo string, codigo string, embalagem string, quantidade_embalagem int, criado_em timestamp"
PENDING_IMAGES = "produto_id string, sku string, descricao string, placeholder_url string"
RAW_PRODUCTS = (
    "sku string, title string, descrFiscal string, ean string, dun string, marca string, classe string, conservacao string,"
    " pesoLiquido string, url string, image_url string, image_status string"
)
CONFLICTS = "id string, produto_id string, tipo string, codigo string, error_message string, timestamp timestamp"
NEW_PRODUCTS = "id string, marca string, ean string, dun string, descricao string, classe string, conservacao string, criado_em timestamp"
CHANGES = "id string, marca string, ean string, dun string, descricao string, alteracoes array<struct<campo:string,de:string,para:string>>, atualizado_em timestamp"
ANOMALIES = "category string, severity string, item_id string, details string"
STAGING = (
    f"fabricantes array<struct<{HOLDINGS.replace(' ', ':').replace(',:', ', ')}>>, marcas array<struct<{BRANDS.replace(' ', ':').replace(',:', ', ')}>>,"
    f" produtos array<struct<{PRODUCTS.replace(' ', ':').replace(',:', ', ')}>>, codigos_barras array<struct<{BARCODES.replace(' ', ':').replace(',:', ', ')}>>,"
    f" pending_images_approval array<struct<{PENDING_IMAGES.replace(' ', ':').replace(',:', ', ')}>>"
)
#: Tenant tables: name -> schema; all but the first belong to the tenant in empresa_id.
TENANT_TABLES = {
    "empresas": "id string, cnpj string, nome string, ativo boolean, criado_em timestamp",
    "profiles": "id string, empresa_id string, nome string, role string, criado_em timestamp",
    "paletes": "id string, empresa_id string, produto_id string, data_validade date, quantidade int, criado_em timestamp",
    "locais_armazenagem": "id string, empresa_id string, camara string, vaga string, criado_em timestamp",
    "auditorias": "id string, empresa_id string, tags array<string>, total int, divergentes int, criado_em timestamp",
    "auditoria_itens": "id string, empresa_id string, auditoria_id string, codigo string, quantidade int, criado_em timestamp",
    "watchlists": "id string, empresa_id string, nome string, itens string, criado_em timestamp",
    "qrcode_auth_sessions": "id string, empresa_id string, token string, status string, criado_em timestamp",
    "logs_sessao": "id string, empresa_id string, evento string, detalhes string, criado_em timestamp",
}

#: table -> (rule, condition that a good row meets); conditions are SQL over the row.
RULES = {
    "fabricantes": [
        ("id_required", "id IS NOT NULL"),
        ("nome_min_length", "nome IS NOT NULL AND length(nome) >= 2"),
        ("cnpj_pattern", r"cnpj IS NULL OR cnpj RLIKE '^[0-9]{2}\\.[0-9]{3}\\.[0-9]{3}/[0-9]{4}-[0-9]{2}$'"),
    ],
    "marcas": [
        ("id_required", "id IS NOT NULL"),
        ("fabricante_required", "fabricante_id IS NOT NULL"),
        ("nome_min_length", "nome IS NOT NULL AND length(nome) >= 1"),
    ],
    "produtos": [
        ("id_required", "id IS NOT NULL"),
        ("marca_required", "marca_id IS NOT NULL"),
        ("descricao_min_length", "descricao_padronizada IS NOT NULL AND length(descricao_padronizada) >= 3"),
        ("classe_required", "classe IS NOT NULL"),
        ("conservacao_enum", "conservacao IS NOT NULL AND conservacao IN ('Resfriado', 'Congelado', 'Temperatura Ambiente', 'Outros')"),
        ("peso_minimum", "peso_gramas IS NULL OR peso_gramas >= 0"),
        ("fracionado_required", "fracionado IS NOT NULL"),
        ("status_enum", "status_imagem IS NULL OR status_imagem IN ('aprovado', 'pendente_aprovacao', 'sem_imagem')"),
    ],
    "codigos_barras": [
        ("id_required", "id IS NOT NULL"),
        ("produto_required", "produto_id IS NOT NULL"),
        ("tipo_enum", "tipo IS NOT NULL AND tipo IN ('SKU', 'EAN', 'DUN')"),
        ("codigo_min_length", "codigo IS NOT NULL AND length(codigo) >= 1"),
    ],
}


def violations(df: DataFrame, table: str) -> DataFrame:
    """id, rule of every rule of the table that a row breaks: one projection, no join."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(F.expr(cond), F.lit(False)), F.lit(rule)) for rule, cond in RULES[table]]), lambda x: x.isNotNull())
    return df.select("id", F.explode(broken).alias("rule"))
