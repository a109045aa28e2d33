"""Interview codes as a canonical list of phrases."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.column import Column

# The phrase of each code, by group and in the order of the result.  Codes that say nothing are left out.
GROUPS = {
    "han_nhiet": {"so_lanh": "sợ lạnh", "so_nong": "sợ nóng, thích mát"},
    "mo_hoi": {"tu_han": "ra mồ hôi nhiều ban ngày", "dao_han": "mồ hôi trộm"},
    "dai_tien": {"tao": "táo bón", "long": "đại tiện lỏng"},
    "tieu_tien": {"vang": "nước tiểu vàng", "trong_dai": "tiểu tiện trong dài"},
    "khat": {"khat_lanh": "khát, thích uống nước lạnh", "khat_am": "khát, thích uống nóng", "khat_khong_uong": "khát nhưng không muốn uống", "khat_nuoc": "khát nước", "mieng_nhat": "miệng nhạt không khát"},
    "an_uong": {"an_kem": "ăn kém", "mau_doi": "ăn nhiều mau đói"},
    "ngu": {"kho_ngu": "mất ngủ"},
}
SEXES = {"nam": "nam giới", "nu": "nữ giới"}
ONSETS = {"moi": "bệnh mới mắc", "vai_ngay": "bệnh vài ngày", "vai_tuan": "bệnh vài tuần", "man": "bệnh mạn tính lâu ngày"}


def _phrase(code: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), F.lower(F.trim(code)))


def canonical(age: Column, sex: Column, onset: Column, answers: Column) -> Column:
    """Age (0 < a < 130), sex, onset and answers (a map of group to code) in a fixed order; unknown codes say nothing."""
    years = F.trim(age.cast("string")).try_cast("int")
    told = F.when((years > 0) & (years < 130), F.concat(years.cast("string"), F.lit(" tuổi")))
    return F.concat_ws(", ", told, _phrase(sex, SEXES), _phrase(onset, ONSETS), *[_phrase(F.try_element_at(answers, F.lit(g)), table) for g, table in GROUPS.items()])


def merged(free: Column, told: Column) -> Column:
    """Free text before the canonical one, without a comma that parts nothing."""
    text = F.trim(F.regexp_replace(F.trim(F.coalesce(free, F.lit(""))), r"[,\s]+$", ""))
    return F.concat_ws(", ", F.nullif(text, F.lit("")), F.nullif(F.trim(F.coalesce(told, F.lit(""))), F.lit("")))
