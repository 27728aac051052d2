"""Declared schemas of the layer tables and ``conform`` to enforce them at write time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

S, I, L, D, DT = StringType(), IntegerType(), LongType(), DoubleType(), DateType()
COUNT_MAP = MapType(StringType(), LongType())
STR_ARRAY = ArrayType(StringType())


# Column and table comments of the original tables.
COLUMN_COMMENTS = {
    "ods_user_travel_sequence": {
        "blog_id": "匿名用户id", "retrieval_date": "数据抓取日期", "departure_date": "出行日期",
        "travel_partners": "同行伙伴类型", "visit_sequence": "景区序列"},
    "ods_poi_dim": {
        "poi_id": "景区id", "name_zh": "景区名称（中文）", "name_en": "景区名称（英文）", "city_zh": "所在城市（中文）",
        "city_en": "所在城市（英文）", "latitude": "纬度", "longitude": "经度", "label_zh": "景区标签（中文）",
        "label_en": "景区标签（英文）"},
    "dwd_poi_info": {
        "poi_id": "景区id", "name": "景区名称", "city": "所在城市", "label": "标签", "category": "景点分类"},
    "dwd_user_travel_sequence_info": {
        "blog_id": "匿名用户id", "trip_id": "旅程id", "travel_date": "出行日期", "travel_partners": "同行伙伴类型",
        "poi_id": "景点id"},
    "dws_user_travel_month": {
        "blog_id": "匿名用户id", "trip_total_cnt": "本月总出行次数", "total_spot_cnt": "本月累计游玩景点数",
        "city_visit_map": "本月每个城市的访问次数", "category_visit_map": "本月每个景点分类的访问次数",
        "partner_visit_map": "本月每种同伴类型的访问次数", "first_trip_date": "本月首次出行日期", "last_trip_date": "本月末次出行日期"},
    "dws_attraction_travel_quarter": {
        "poi_id": "景点ID", "name": "景点名称", "city": "所在城市", "category": "景点分类",
        "visit_total_cnt": "本季度该景点被游玩的总人次", "partner_map": "游客同伴类型分布",
        "visit_cnt_growth_rate": "对比上季度总人次增长率", "is_hot_rising": "是否热度上升：是/否/无上期数据"},
    "dws_city_travel_quarter": {
        "city": "城市名称", "visit_trip_cnt": "本季度该城市被访问的总次数", "unique_attraction_cnt": "本季度该城市被游玩的不重复景点数",
        "partner_map": "游客同伴类型分布", "visit_cnt_growth_rate": "对比上季度用户数增长率",
        "is_hot_rising": "是否热度上升：是/否/无上期数据"},
    "ads_user_portrait": {
        "blog_id": "用户id", "total_trips": "总出行次数", "total_spots": "总游览景点数", "favorite_city": "最常去的城市",
        "favorite_category": "最偏好的景点类型", "favorite_partner": "最爱的同伴类型", "user_level": "活跃等级：高频/中频/低频",
        "user_status": "用户状态：活跃/流失"},
    "ads_top50_attractions_last_year": {
        "year_quarter": "年份季度", "poi_id": "景点id", "name": "景点名称", "city": "所在城市", "category": "景点分类",
        "visit_total_cnt": "访问总人次", "top_partner": "最热门的出游方式", "rank": "季度热度排名", "is_hot_rising": "是否热度上升",
        "visit_cnt_growth_rate": "环比增长率"},
    "ads_city_top10_last_year": {
        "year_quarter": "年份季度", "city": "城市名称", "visit_trip_cnt": "访问次数", "unique_attraction_cnt": "被访问的不同景点数",
        "top_partner": "最热门的出游方式", "rank": "季度热度排名", "is_hot_rising": "是否热度上升"},
}

TABLE_COMMENTS = {
    "ods_user_travel_sequence": "ods层-用户出行轨迹原始表",
    "ods_poi_dim": "ods层-景区维度表",
    "dwd_poi_info": "dwd层-景区清洗明细表",
    "dwd_user_travel_sequence_info": "dwd层-用户出行明细清洗表",
    "dws_user_travel_month": "dws层-用户月度出行主题宽表",
    "dws_attraction_travel_quarter": "dws层-景点热度主题表",
    "dws_city_travel_quarter": "dws层-城市季度热度主题表",
    "ads_user_portrait": "ads层-用户画像表",
    "ads_top50_attractions_last_year": "ads层-最近一年热门景点top50",
    "ads_city_top10_last_year": "ads层-最近一年城市热度top10",
}


def _schema(table: str, *fields: tuple) -> StructType:
    """A table's declared schema; a column's comment is carried as its metadata."""
    notes = COLUMN_COMMENTS[table]
    return StructType([StructField(name, typ, True, {"comment": notes[name]} if name in notes else None)
                       for name, typ in fields])


ODS_POI = _schema("ods_poi_dim", ("poi_id", S), ("name_zh", S), ("name_en", S), ("city_zh", S), ("city_en", S),
                  ("latitude", DecimalType(10, 6)), ("longitude", DecimalType(10, 6)),
                  ("label_zh", S), ("label_en", S))
ODS_TRIP = _schema("ods_user_travel_sequence", ("blog_id", S), ("retrieval_date", S), ("departure_date", S),
                   ("travel_partners", S), ("visit_sequence", S))
DWD_POI = _schema("dwd_poi_info", ("poi_id", S), ("name", S), ("city", S), ("label", STR_ARRAY), ("category", S))
DWD_VISIT = _schema("dwd_user_travel_sequence_info", ("blog_id", S), ("trip_id", S), ("travel_date", DT), ("travel_partners", S),
                    ("poi_id", S), ("travel_year", I), ("travel_month", I))
DWS_USER_MONTH = _schema("dws_user_travel_month", ("blog_id", S), ("trip_total_cnt", L), ("total_spot_cnt", L),
                         ("city_visit_map", COUNT_MAP), ("category_visit_map", COUNT_MAP),
                         ("partner_visit_map", COUNT_MAP), ("first_trip_date", DT), ("last_trip_date", DT),
                         ("travel_year", I), ("travel_month", I))
DWS_ATTRACTION_QUARTER = _schema("dws_attraction_travel_quarter", ("poi_id", S), ("name", S), ("city", S), ("category", S),
                                 ("visit_total_cnt", L), ("partner_map", COUNT_MAP),
                                 ("visit_cnt_growth_rate", D), ("is_hot_rising", S),
                                 ("travel_year", I), ("travel_quarter", I))
DWS_CITY_QUARTER = _schema("dws_city_travel_quarter", ("city", S), ("visit_trip_cnt", L), ("unique_attraction_cnt", L),
                           ("partner_map", COUNT_MAP), ("visit_cnt_growth_rate", D), ("is_hot_rising", S),
                           ("travel_year", I), ("travel_quarter", I))
ADS_USER_PORTRAIT = _schema("ads_user_portrait", ("blog_id", S), ("total_trips", L), ("total_spots", L),
                            ("favorite_city", STR_ARRAY), ("favorite_category", STR_ARRAY),
                            ("favorite_partner", STR_ARRAY), ("user_level", S), ("user_status", S))
ADS_TOP_ATTRACTIONS = _schema("ads_top50_attractions_last_year", ("year_quarter", S), ("poi_id", S), ("name", S), ("city", S), ("category", S),
                              ("visit_total_cnt", L), ("top_partner", STR_ARRAY), ("rank", I),
                              ("is_hot_rising", S), ("visit_cnt_growth_rate", D))
ADS_TOP_CITIES = _schema("ads_city_top10_last_year", ("year_quarter", S), ("city", S), ("visit_trip_cnt", L), ("unique_attraction_cnt", L),
                         ("top_partner", STR_ARRAY), ("rank", I), ("is_hot_rising", S))

# name -> (schema, partition columns); the layer is the prefix.
TABLES: dict[str, tuple[StructType, tuple[str, ...]]] = {
    "ods_poi_dim": (ODS_POI, ()),
    "ods_user_travel_sequence": (ODS_TRIP, ()),
    "dwd_poi_info": (DWD_POI, ()),
    "dwd_user_travel_sequence_info": (DWD_VISIT, ("travel_year", "travel_month")),
    "dws_user_travel_month": (DWS_USER_MONTH, ("travel_year", "travel_month")),
    "dws_attraction_travel_quarter": (DWS_ATTRACTION_QUARTER, ("travel_year", "travel_quarter")),
    "dws_city_travel_quarter": (DWS_CITY_QUARTER, ("travel_year", "travel_quarter")),
    "ads_user_portrait": (ADS_USER_PORTRAIT, ()),
    "ads_top50_attractions_last_year": (ADS_TOP_ATTRACTIONS, ()),
    "ads_city_top10_last_year": (ADS_TOP_CITIES, ()),
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns by name, in declared order, cast to the declared types.

    Text parsed into another type (e.g. a CSV latitude into DECIMAL(10,6)) uses ``try_cast``: a
    malformed value becomes NULL instead of failing the whole load under ANSI mode. Every
    other conversion is a strict cast, so an overflowing count still raises."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    have = dict((f.name, f.dataType) for f in df.schema.fields)
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        parse = isinstance(have[f.name], StringType) and not isinstance(f.dataType, StringType)
        c = c.try_cast(f.dataType) if parse else c.cast(f.dataType)
        cols.append(c.alias(f.name, metadata=f.metadata) if f.metadata else c.alias(f.name))
    return df.select(*cols)
