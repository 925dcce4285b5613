from loomstar.operators.analytics import (
    counts_by, day_counts, order_by_count, plays_by_weekday_hour, star_counts, top_artists, top_artists_all, top_k,
    top_songs, top_users,
)
from loomstar.operators.dedup import pick_per_key
from loomstar.operators.dimensions import (
    artists_dim, dimension, songs_dim, time_dim, time_dim_from_fact, users_dim,
)
from loomstar.operators.facts import catalogue, songplays, with_start_time
from loomstar.operators.filters import non_empty, plays, preview, project_play11
from loomstar.operators.lookups import (
    q_session_item, q_user_session, q_users_by_song, song_data_by_session,
    song_data_by_user_and_session, user_data_by_song,
)
from loomstar.operators.quality import (
    DataQualityError, assert_checks, fingerprints, fk_violations, fused_checks, has_rows_checks, null_violations,
    pk_violations, row_count, row_counts, run_checks, star_checks,
)
from loomstar.operators.skew import lookup_join, measured_bytes, sized

__all__ = [
    "DataQualityError", "artists_dim", "assert_checks", "catalogue", "counts_by", "day_counts", "dimension",
    "fingerprints", "fk_violations", "fused_checks", "has_rows_checks", "lookup_join", "measured_bytes",
    "non_empty", "null_violations", "order_by_count", "pick_per_key", "pk_violations", "plays",
    "plays_by_weekday_hour", "preview", "project_play11", "q_session_item", "q_user_session",
    "q_users_by_song", "row_count", "row_counts", "run_checks", "sized", "song_data_by_session",
    "song_data_by_user_and_session", "songplays", "songs_dim", "star_checks", "star_counts", "time_dim",
    "time_dim_from_fact", "top_artists", "top_artists_all", "top_k", "top_songs", "top_users",
    "user_data_by_song", "users_dim", "with_start_time",
]
