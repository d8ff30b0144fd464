"""Key functions as column expressions; all of them run inside Catalyst."""

from .gchain import (
    assert_one_depth,
    gchain_depth,
    gchain_key_to_bounds,
    gchain_segment,
    gchain_trim_key,
    segment_gchain_key,
    to_gchain_key,
)
from .grid import (
    box,
    box_wkt,
    coord_to_gid,
    coord_to_grid_id,
    coord_to_quadrant,
    gid_to_coord,
    grid_id_to_coord,
    grid_id_to_envelope,
    grid_id_to_wgs84_coord,
    grid_id_to_wgs84_envelope,
    modulo,
    modulo_int,
    point_to_grid_id,
    wgs84_coord_to_grid_id,
)
from .identity import (
    imo_checksum,
    is_valid_imo,
    is_valid_mmsi,
    mmsi_to_mid,
    mmsi_to_radio_service_type,
)
from .quadkey import (
    compute_qkey_range,
    get_zxy,
    int_to_quadkey,
    int_to_quadkey_bytes,
    quadkey_bit_encode,
    quadkey_int16_encode,
    quadkey_int32_encode,
    quadkey_int64_encode,
    quadkey_to_int,
    quadkey_to_zxy,
    quadkey_uint16_encode,
    quadkey_uint32_encode,
    quadkey_uint64_encode,
    zxy_to_quadkey,
)
from .sqlfunctions import SQL_FUNCTIONS, register_functions
from .timekeys import (
    date_id_to_timestamp,
    datetime_keys_to_timestamp,
    minutes_since_midnight,
    time_id_to_timestamp,
    timestamp_to_date_id,
    timestamp_to_time_id,
    ts_to_temporal_part_key,
)
