-- Recent rows of the dashboard base.
-- Parameters: :source_table (table name), :dias (lookback days),
--             :as_of (last day of the lookback, NULL = today).
SELECT session_id, id, message_date, history, fecha_inicio, fecha_fin,
       cantidad_mensajes, mensajes_usuario, mensajes_bot, tipo_sesion,
       duracion_minutos, isn
FROM IDENTIFIER(:source_table)
WHERE message_date >= date_sub(coalesce(CAST(:as_of AS DATE), current_date()), :dias)
