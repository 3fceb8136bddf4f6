"""Field catalogue of the bronze and silver layers and the fixed lists used by the stages."""

from __future__ import annotations

from pyspark.sql import types as T

# One line per mapped bronze field, in record order:
# (bronze name, silver name, kind).  Kinds: text (required), text? (nullable), flag (false when
# absent), flag+ (true when absent), int (0 when absent), int? (nullable), real, real?, iso,
# json? (null when empty), json{} / json[] (empty object / array when absent).
FIELDS: tuple[tuple[str, str, str], ...] = (
    ("id", "id", "text"),
    ("title", "titulo", "text"),
    ("selftext", "texto", "text"),
    ("author", "autor", "text?"),
    ("author_fullname", "autor_nombre_completo", "text?"),
    ("author_premium", "autor_premium", "flag"),
    ("author_patreon_flair", "autor_patreon", "flag"),
    ("author_flair_text", "autor_flair_texto", "text?"),
    ("author_flair_css_class", "autor_flair_css", "text?"),
    ("author_flair_type", "autor_flair_tipo", "text?"),
    ("subreddit", "subreddit_nombre", "text"),
    ("subreddit_id", "subreddit_id", "text"),
    ("subreddit_name_prefixed", "subreddit_prefijado", "text"),
    ("subreddit_type", "subreddit_tipo", "text?"),
    ("subreddit_subscribers", "subreddit_suscriptores", "int"),
    ("created_utc", "fecha_creacion_utc", "real"),
    ("created_ts", "fecha_creacion", "iso"),
    ("edited_bool", "editado", "flag"),
    ("edited_utc", "editado_fecha", "real?"),
    ("distinguished", "distinguido", "text?"),
    ("is_self", "es_texto", "flag"),
    ("over_18", "es_adulto", "flag"),
    ("spoiler", "es_spoiler", "flag"),
    ("locked", "esta_bloqueado", "flag"),
    ("archived", "archivado", "flag"),
    ("quarantine", "en_cuarentena", "flag"),
    ("stickied", "esta_fijado", "flag"),
    ("is_original_content", "es_original", "flag"),
    ("is_meta", "es_meta", "flag"),
    ("is_crosspostable", "es_compartible", "flag+"),
    ("score", "puntaje", "int"),
    ("ups", "votos_positivos", "int"),
    ("downs", "votos_negativos", "int"),
    ("upvote_ratio", "ratio_upvotes", "real"),
    ("num_comments", "total_comentarios", "int"),
    ("num_crossposts", "total_republicaciones", "int"),
    ("view_count", "vistas", "int?"),
    ("visited", "visitado", "flag"),
    ("hide_score", "ocultar_puntaje", "flag"),
    ("send_replies", "enviar_respuestas", "flag+"),
    ("can_mod_post", "puede_mod", "flag"),
    ("suggested_sort", "orden_sugerido", "text?"),
    ("domain", "dominio", "text"),
    ("url", "url", "text"),
    ("url_overridden_by_dest", "url_destino", "text?"),
    ("permalink", "enlace_permanente", "text"),
    ("thumbnail", "miniatura", "text"),
    ("thumbnail_height", "miniatura_alto", "int?"),
    ("thumbnail_width", "miniatura_ancho", "int?"),
    ("post_hint", "pista_contenido", "text?"),
    ("is_video", "es_video", "flag"),
    ("is_gallery", "es_galeria", "flag"),
    ("media_only", "solo_media", "flag"),
    ("media", "media_json", "json?"),
    ("secure_media", "media_segura_json", "json?"),
    ("media_embed", "media_embed_json", "json{}"),
    ("secure_media_embed", "media_segura_embed_json", "json{}"),
    ("preview", "previsualizacion_json", "json?"),
    ("gallery_data", "datos_galeria_json", "json?"),
    ("media_metadata", "metadatos_media_json", "json{}"),
    ("link_flair_text", "flair_texto", "text?"),
    ("link_flair_css_class", "flair_css", "text?"),
    ("link_flair_type", "flair_tipo", "text?"),
    ("link_flair_richtext", "flair_richtext_json", "json[]"),
    ("author_flair_richtext", "autor_flair_richtext_json", "json[]"),
    ("crosspost_parent", "padre_republicacion", "text?"),
    ("crosspost_parent_list", "lista_republicaciones_json", "json[]"),
    ("parent_whitelist_status", "estado_lista_blanca_padre", "text?"),
    ("whitelist_status", "estado_lista_blanca", "text?"),
    ("wls", "wls", "int?"),
    ("pwls", "pwls", "int?"),
    ("content_categories", "categorias_contenido_json", "json[]"),
    ("discussion_type", "tipo_discusion", "text?"),
    ("treatment_tags", "etiquetas_tratamiento_json", "json[]"),
    ("is_robot_indexable", "indexable_por_robot", "flag+"),
    ("author_is_blocked", "autor_bloqueado", "flag"),
    ("awarders", "premiadores_json", "json[]"),
    ("all_awardings", "premiaciones_json", "json[]"),
    ("total_awards_received", "total_premios", "int"),
    ("gilded", "gilded", "int"),
    ("gildings", "gildings_json", "json{}"),
    ("poll_data", "datos_encuesta_json", "json?"),
)

RENAMES: dict[str, str] = {bronze: silver for bronze, silver, _ in FIELDS}

_KIND_TYPES = {"flag": T.BooleanType(), "int": T.LongType(), "real": T.DoubleType()}


def spark_type(kind: str) -> T.DataType:
    """Storage type of a field kind; text, iso and json fields are strings."""
    return _KIND_TYPES.get(kind.rstrip("?+"), T.StringType())


BRONZE_SCHEMA = T.StructType(
    [T.StructField(bronze, spark_type(kind)) for bronze, _, kind in FIELDS]
    + [
        T.StructField("_ingest_ts", T.DoubleType()),
        T.StructField("_ingest_ts_ts", T.StringType()),
        T.StructField("raw_payload", T.StringType()),
        T.StructField("extras", T.MapType(T.StringType(), T.StringType())),
    ]
)

# Landed posts: the same names before splitting ``edited``; nested values arrive as JSON text.
RAW_SCHEMA = T.StructType(
    [T.StructField(bronze, spark_type(kind)) for bronze, _, kind in FIELDS
     if bronze not in ("created_ts", "edited_bool", "edited_utc")]
    + [T.StructField("edited", T.StringType())]
)

# Columns that receive the "NA" sentinel on request (silver names).
SENTINEL_COLUMNS = (
    "editado_fecha", "distinguido", "vistas", "datos_galeria_json", "padre_republicacion",
    "estado_lista_blanca_padre", "estado_lista_blanca", "datos_encuesta_json", "tipo_discusion",
)

# Preparation of the sentiment data set.
TARGET_SUBREDDITS = ("technology", "artificial", "futurology")
LANGUAGES = ("es", "en")
MIN_TEXT_LENGTH = 20
KEEP_FIRST = (
    "id", "subreddit_nombre", "fecha_creacion_utc", "titulo", "texto", "titulo_limpio",
    "texto_limpio", "puntaje", "total_comentarios", "ratio_upvotes", "autor", "autor_premium",
    "autor_patreon", "es_adulto", "es_spoiler", "solo_media",
    "texto_model", "idioma_detectado", "longitud_texto",
)
DROPPED = (
    "miniatura", "miniatura_alto", "miniatura_ancho", "autor_flair_css", "flair_css",
    "autor_flair_richtext_json", "flair_richtext_json", "media_json", "media_segura_json",
    "media_embed_json", "media_segura_embed_json", "previsualizacion_json", "datos_galeria_json",
    "metadatos_media_json", "premiadores_json", "premiaciones_json", "gildings_json",
    "lista_republicaciones_json", "datos_encuesta_json", "categorias_contenido_json",
    "etiquetas_tratamiento_json", "raw_payload", "extras", "wls", "pwls", "estado_lista_blanca",
    "estado_lista_blanca_padre",
)
TRAINING_FIRST = (
    "id", "subreddit_nombre", "fecha_creacion_utc", "texto_model", "sentimiento_label", "label",
    "p_neg", "p_neu", "p_pos",
)
NUMERIC_PROFILE = ("puntaje", "total_comentarios", "ratio_upvotes", "longitud_texto")
TEXT_CHOICES = ("texto_model", "texto_limpio", "texto", "titulo_limpio", "titulo")

# Live collection defaults (the list is distinct) and archive date range.
SUBREDDITS = (
    "politics", "worldnews", "technology", "health", "ecuador", "business", "technews",
    "artificial", "futurology", "tecnología", "datasciencees",
)
MICROBATCH_LIMIT = 100
MICROBATCH_SECONDS = 60
ARCHIVE_START = 1577836800  # 2020-01-01 00:00:00 UTC
ARCHIVE_END = 1735689599    # 2024-12-31 23:59:59 UTC
