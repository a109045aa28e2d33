"""Structured observations of tongue and face: canonical findings, and a sentence to show."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.column import Column

# Canonical findings of a structured observation.
TONGUE_BODY = {"nhợt": "lưỡi nhợt", "đỏ": "lưỡi đỏ", "đỏ sẫm": "lưỡi đỏ sẫm", "tím": "lưỡi có vết bầm tím"}
COAT_COLOURS = {"trắng": "trắng", "vàng": "vàng", "xám đen": "xám"}
FACE_COLOURS = {"trắng nhợt": "mặt nhợt nhạt", "vàng úa": "mặt vàng", "đỏ bừng": "mặt đỏ", "xanh xao": "mặt xanh", "sạm tối": "sắc mặt ám tối"}
TONGUE_SIGNS = {"luoi_beu": "lưỡi bệu", "dau_rang": "rìa lưỡi có hằn răng", "vet_nut": "lưỡi có vết nứt"}
FACE_SIGNS = {"go_ma_do": "hai gò má đỏ", "phu": "mặt phù", "ban_do": "mặt có ban", "quang_tham": "quầng đen dưới mắt"}
# The same signs as a shown sentence has them.
TONGUE_SHOWN = {"luoi_beu": "lưỡi bệu", "dau_rang": "rìa lưỡi có dấu răng", "vet_nut": "bề mặt có vết nứt"}
FACE_SHOWN = {"go_ma_do": "hai gò má đỏ", "phu": "mặt phù", "ban_do": "có ban đỏ", "quang_tham": "quầng thâm mắt", "trang_diem": "(có trang điểm)"}
YES, NO_COAT, PEELED, UNSURE = "có", "không rêu", "bong tróc", "không rõ"
#: Values that say nothing; a healthy complexion is shown all the same.
SILENT = ["", UNSURE, "không"]


def _value(t: Column, field: str) -> Column:
    return F.coalesce(F.lower(F.trim(t[field])), F.lit(""))


def _mapped(c: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c)


def _signs(t: Column, table: dict[str, str]) -> list[Column]:
    return [F.when(_value(t, field) == YES, name) for field, name in table.items()]


def tongue_findings(t: Column) -> Column:
    """Ordered findings of a struct with than_luoi, luoi_beu, dau_rang, vet_nut, reu_mau, reu_day and reu_chat."""
    colour, depth, kind = _value(t, "reu_mau"), _value(t, "reu_day"), _value(t, "reu_chat")
    shade = _mapped(colour, COAT_COLOURS)
    more = F.when(kind == "nhớt", " nhớt").when(depth == "dày", " dày").when(depth == "mỏng", " mỏng").when(kind == "khô", " khô").otherwise("")
    coat = F.when(kind == PEELED, "rêu bong tróc").when(colour == NO_COAT, "lưỡi không có rêu").when(shade.isNotNull(), F.concat(F.lit("rêu "), shade, more))
    return F.array_compact(F.array(_mapped(_value(t, "than_luoi"), TONGUE_BODY), *_signs(t, TONGUE_SIGNS), coat))


def face_findings(t: Column) -> Column:
    return F.array_compact(F.array(_mapped(_value(t, "sac_mat"), FACE_COLOURS), *_signs(t, FACE_SIGNS)))


def _sentence(head: str, parts: Column) -> Column:
    return F.when(F.size(parts) > 0, F.concat(F.lit(head), F.array_join(parts, ", "), F.lit("."))).otherwise("")


def _said(c: Column) -> Column:
    return F.when(~c.isin(SILENT), c)


def tongue_sentence(t: Column) -> Column:
    """What the observation says, for display."""
    body, colour = _said(_value(t, "than_luoi")), _value(t, "reu_mau")
    coat = F.when(colour == NO_COAT, "không có rêu").when(~colour.isin(SILENT), F.concat_ws(" ", F.lit("rêu"), colour, _said(_value(t, "reu_day")), _said(_value(t, "reu_chat"))))
    return _sentence("Lưỡi: ", F.array_compact(F.array(F.concat(F.lit("thân lưỡi "), body), coat, *_signs(t, TONGUE_SHOWN))))


def face_sentence(t: Column) -> Column:
    """As ``tongue_sentence``; any known complexion is shown, a healthy one too."""
    colour = _value(t, "sac_mat")
    shown = F.when(~colour.isin("", UNSURE), F.concat(F.lit("sắc mặt "), colour))
    return _sentence("Sắc mặt: ", F.array_compact(F.array(shown, *_signs(t, FACE_SHOWN))))
