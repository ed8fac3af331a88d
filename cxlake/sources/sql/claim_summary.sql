-- Monthly claim summary per class from a detail table. Amounts that an exact
-- sum can't hold are an error.
-- Parameters: :source_table (detail table name).
WITH sums AS (
  SELECT Mes, Clasificacion, count(*) AS n, sum(CAST(Valor_Declarado_CLP AS DECIMAL(38,3))) AS total
  FROM IDENTIFIER(:source_table)
  GROUP BY Mes, Clasificacion
), units AS (
  SELECT *, CAST(total * 1000 AS DECIMAL(38,0)) AS u, CAST(n AS DECIMAL(38,0)) AS d FROM sums
)
SELECT Mes, Clasificacion, CAST(n AS INT) AS Cantidad, CAST(total AS DOUBLE) AS Suma_Total_CLP,
       CAST(CAST((u - u % d) / d AS DECIMAL(38,0))
            + CASE WHEN 2 * abs(u % d) >= d THEN CAST(signum(u) AS INT) ELSE 0 END AS DOUBLE) / 1000.0D AS Promedio_CLP
FROM units
