"""Column names of the stored tables and the names used in this library."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Stored column name -> library column name.
STORED_TO_LIBRARY = {
    "id_venda": "sale_id",
    "data_venda": "sale_date",
    "ano": "year",
    "mes": "month",
    "dia": "day",
    "hora": "hour",
    "id_produto": "product_id",
    "id_cliente": "customer_id",
    "id_regiao": "region_id",
    "quantidade": "quantity",
    "valor_unitario": "unit_price",
    "desconto": "discount",
    "valor_total": "total_value",
    "canal_venda": "channel",
    "status_venda": "status",
    "nome_cliente": "customer_name",
    "segmento": "segment",
    "estado": "state",
    "data_cadastro": "registered_on",
    "nome_produto": "product_name",
    "categoria": "category",
    "preco_unitario": "list_price",
    "fornecedor": "supplier",
    "ativo": "active",
    "nome_regiao": "region_name",
    "is_alto_valor": "is_high_value",
    "total_pedidos": "orders",
    "total_unidades": "units",
    "receita_bruta": "revenue",
    "ticket_medio": "ticket_mean",
    "maior_venda": "largest_sale",
    "menor_venda": "smallest_sale",
    "segmento_cliente": "customer_segment",
    "estado_cliente": "customer_state",
    "media_pedidos_mensais": "orders_per_month",
    "media_compras_ultimos_6_meses": "orders_per_month_6m",
    "receita_total": "total_revenue",
    "qtd_categorias": "category_count",
    "canal_preferido": "preferred_channel",
    "taxa_cancelamento": "cancel_rate",
    "qtd_pedidos_alto_valor": "high_value_orders",
    "dias_ultima_compra": "days_since_purchase",
    "score_rfm": "rfm_score",
    "label_churn_risco": "churn_label",
}
LIBRARY_TO_STORED = {library: stored for stored, library in STORED_TO_LIBRARY.items()}


def from_stored(df: DataFrame) -> DataFrame:
    """Rename stored columns to library names; other columns pass through."""
    return df.withColumnsRenamed(STORED_TO_LIBRARY)


def to_stored(df: DataFrame) -> DataFrame:
    """Rename library columns to stored names; other columns pass through."""
    return df.withColumnsRenamed(LIBRARY_TO_STORED)
