"""Built-in table definitions and their persisted schemas."""

from __future__ import annotations

from cxlake.plans.tabledef import TableDef

# Persisted schemas of the claim tables (column names and types are part of
# the data model and fixed).
DETAIL_DDL = (
    "Mes STRING, Clasificacion STRING, OT STRING, Valor_Declarado_CLP DOUBLE, "
    "Fecha_Creacion TIMESTAMP, Usuario STRING, fecha_carga TIMESTAMP"
)
SUMMARY_DDL = (
    "Mes STRING, Clasificacion STRING, Cantidad INT, Suma_Total_CLP DOUBLE, "
    "Promedio_CLP DOUBLE, fecha_carga TIMESTAMP"
)
EVOLUTION_DDL = "Mes STRING, Clasificacion STRING, Suma_Total_CLP DOUBLE, Cantidad BIGINT, fecha_carga TIMESTAMP"
TOP_DDL = "Clasificacion STRING, Suma_Total_CLP DOUBLE, Cantidad BIGINT, Promedio_CLP DOUBLE, fecha_carga TIMESTAMP"

DETAIL_KEY = ("Mes", "Clasificacion", "OT")


def default_table_defs(database: str | None = None) -> dict[str, TableDef]:
    defs = [
        TableDef(
            name="claim_detail",
            origin="python",
            python_source="claim_detail",
            database=database,
            schema_ddl=DETAIL_DDL,
            mode="merge",
            primary_key=DETAIL_KEY,
            partition_by="Mes",
            cluster_by=("Clasificacion",),
            lookback_days=3,
            description="First classified record per work order",
        ),
        TableDef(
            name="claim_summary",
            origin="python",
            python_source="claim_summary",
            database=database,
            schema_ddl=SUMMARY_DDL,
            mode="overwrite",
            description="Monthly count, total and average per class",
        ),
        TableDef(
            name="claim_evolution",
            origin="python",
            python_source="claim_evolution",
            database=database,
            schema_ddl=EVOLUTION_DDL,
            mode="overwrite",
            description="Monthly total and count per class",
        ),
        TableDef(
            name="claim_top",
            origin="python",
            python_source="claim_top",
            database=database,
            schema_ddl=TOP_DDL,
            mode="overwrite",
            description="Classes by total over all months",
        ),
        TableDef(
            name="dashboard_base",
            origin="python",
            python_source="dashboard_base",
            database=database,
            mode="overwrite_partitions",
            partition_by="message_date",
            lookback_days=3,
            description="Conversation dashboard per session-day",
        ),
        TableDef(
            name="session_history",
            origin="python",
            python_source="session_history",
            database=database,
            mode="overwrite_partitions",
            partition_by="message_date",
            cluster_by=("session_id", "chunk"),
            lookback_days=3,
            description="Ordered messages per session-day, in chunks of bounded size",
        ),
        TableDef(
            name="dashboard_recent",
            origin="sql",
            query_sql_path="dashboard_recent.sql",
            depends_on=("dashboard_base",),
            database=database,
            mode="overwrite",
            lookback_days=3,
            params={"source_table": f"{database}.dashboard_base" if database else "dashboard_base", "as_of": None},
            description="Recent rows of the dashboard base",
        ),
    ]
    return {d.name: d for d in defs}
