"""Cleaners, parsers and detectors on texts whose results are known."""

from __future__ import annotations

from pyspark.sql import functions as F

from trellis.functions import clean, findings, guard, interview, terms
from trellis.functions import text as T
from trellis.functions import textkeys as K
from trellis.plans.registry import cases

joined = lambda c: F.array_join(c, "|")

cases("synonym_rewrite", T.rewrite_synonyms, [("đầy trướng  bụng", "bụng đầy trướng"), ("Trướng bụng và bụng chướng", "bụng trướng và chướng bụng"), (" trướng  đầy ", "trướng đầy"), ("trướng bụngx", "trướng bụngx")])
cases("read_only_guard", guard.read_only, [("MATCH (n) RETURN n", "true"), ("MATCH (n) DELETE n", "false"), ("RETURN 'delete me'", "true"), ("RETURN 1; RETURN 2", "false"), ("RETURN 1 /* set */;", "true"), ("", "false")])
cases("schema_names", guard.repaired_names, [("[:CÓ BIỂU HIỆN]", "[:CÓ_BIỂU_HIỆN]"), ("ĐƯỢC_ĐIỀU TRỊ_BẰNG, BAO GÔM", "ĐƯỢC_ĐIỀU_TRỊ_BẰNG, BAO_GỒM"), ("TƯƠNG ỨNG TÂY Y", "TƯƠNG_ỨNG_TÂY_Y"), ("KHÁC", "KHÁC")])
cases("word_boundaries", lambda c: F.concat_ws(",", K.letter_bounded(c, "ho").cast("int"), K.word_bounded(F.lower(c), "ho").cast("int"), K.not_in_word(F.lower(c), "ho").cast("int")), [("ho khan", "1,1,1"), ("Ho2", "1,0,0"), ("choáng", "0,0,0"), ("áho", "0,0,0"), ("a_ho", "1,0,0"), ("(ho)", "1,1,1")])
cases("display_space", K.display_ws, [("  a \t b ", "a b"), ("\ta", "a"), ("", "")])
cases("normal_keys", lambda c: F.concat_ws("/", K.norm_key(c), K.exact_key(c), K.fold_sparse(c), K.fold(c)), [("Ｓtraße  x", "strasse x/strasse x/strasse  x/ｓtrasse  x"), ("Đau_đầu!", "đau_đầu!/đau đầu/dau_dau!/dau_dau!"), ("É", "é/é/e/e")])
cases("full_match", lambda c: c.rlike("^(?:red .*|.* bolt)$").cast("string"), [("red ring", "true"), ("a bolt", "true"), ("a red ring", "false"), ("bolt", "false")])
cases("herb_names", lambda c: F.concat_ws("/", joined(clean.herb_list(c)), joined(clean.herb_list(c, True))), [("Cam thảo (chích), Quế (nếu lạnh); Gừng", "Cam thảo|Quế|Gừng/Cam thảo (chích)|Quế|Gừng"), ("Sâm, gia giảm. Quy", "Sâm|Quy/Sâm|Quy"), ("", "/"), (None, "/")])
cases("dirty_lists", lambda c: F.concat_ws("/", joined(clean.dirty_list(c)["items"]), joined(clean.dirty_list(c)["flags"])), [('["sốt", "ho khan"]', "sốt|ho khan/"), ("['đau, nặng', 'ngứa']", "đau, nặng|ngứa/"), ("'mệt,''khát nước", "mệt|khát nước/cut"), ("'sốt' và 'ngứa'", "sốt|ngứa/"), ("Job's tears, 'gừng', sâm", "Job's tears|gừng|sâm/cut"), ("chụp CT tai, mũi, họng", "chụp CT tai, mũi, họng/"), ("đau (nhẹ, vừa), buồn nôn, sốt cao", "đau (nhẹ, vừa)|buồn nôn|sốt cao/"), ("Không có thông tin", "/"), ("['sốt', 'SỐT', 'sôt']", "sốt/"), (None, "/")])
cases("placeholders", lambda c: clean.is_placeholder(c).cast("string"), [("Không có thông tin liên quan.", "true"), ("Hiện tại, chưa có dữ liệu", "true"), ("không rõ", "true"), ("Không có phương pháp điều trị", "false"), ("không có" + " chi tiết" * 12, "false")])
cases("prevention_lines", lambda c: F.concat_ws("/", F.replace(clean.prevention_lines(c)["kept"], F.lit("\n"), F.lit("|")), F.replace(clean.prevention_lines(c)["moved"], F.lit("\n"), F.lit("|"))), [("Rửa tay\nUống thuốc kháng sinh\n\nKhông có thông tin", "Rửa tay/Uống thuốc kháng sinh"), ("Aspirin 100 mg mỗi ngày\r\nĂn 500g rau", "Ăn 500g rau/Aspirin 100 mg mỗi ngày"), ("Tiêm phòng vắc-xin 2 lần/ngày thuốc", "Tiêm phòng vắc-xin 2 lần/ngày thuốc/"), ("Bỏ thuốc lá 2 lần một ngày", "Bỏ thuốc lá 2 lần một ngày/"), ("Bôi thuốc 5 %", "/Bôi thuốc 5 %"), ("", "/")])
cases("leads", lambda c: F.concat_ws("/", clean.first_sentence(c), clean.lead(c)), [("\n 1. Viêm gan là bệnh. Câu hai", "1/1"), ("Viêm gan (B) là bệnh. Câu hai", "Viêm gan (B) là bệnh/Viêm gan"), ("2) Sởi, còn gọi ban đỏ! Hết", "2) Sởi, còn gọi ban đỏ/Sởi"), ("Lao thường gặp\nở phổi", "Lao thường gặp/Lao"), ("", "/")])
cases("title_variants", lambda c: joined(clean.title_variants(c)), [("Viêm gan (B [mạn])", "Viêm gan (B [mạn])|Viêm gan"), ("Sởi", "Sởi"), ("(a)", "(a)"), ("Lao 【x】 phổi", "Lao 【x】 phổi|Lao phổi"), ("A - ()", "A - ()")])
cases("risk_reasons", lambda c: F.concat_ws("/", *[joined(clean.risks(F.substring_index(c, "#", 1), F.substring_index(c, "#", -1))[f]) for f in ("ui", "tcm", "low_info")]), [("Trang chủ#Một câu mô tả đủ dài để nói lên điều gì đó. Hai", "known_ui_title//"), ("Bản mẫu: x#Theo đông y và nội kinh thì bệnh này rất hay gặp", "template_title/đông y|nội kinh/"), ("Viêm#Viêm", "//first_sentence_under_30_alnum|first_sentence_equals_name|generic_title"), ("Lao# ", "//description_empty"), ("Sởi#Tên giấy chứng nhận bệnh sởi của người bệnh trẻ em", "//certificate_or_name_metadata")])
cases("syndrome_cleaner", clean.clean_syndrome, [("Cổ trướng do Âm hư huyết ứ", "Âm hư huyết ứ"), ("Giai đoạn đầu (phong hàn)", "Phong hàn"), ("tỳ hư (kèm thấp)", "Tỳ hư"), ("A - B (c)", None), ("Tỳ hư", None), ("Chung (bổ thận)", None), ("Do X (thấp 2)", None), ("Khí hư (x) ", "Khí hư")])
cases("symptom_fragments", lambda c: joined(clean.symptom_fragments(c)), [("Sốt cao; hoặc ho (đêm). nếu nặng thì mê sảng", "Sốt cao"), ("đau lưng nhưng ăn được… Đau lưng", "đau lưng|ăn được"), ("mệt (khi", "mệt"), ("x", "")])
cases("cell_cleaner", clean.clean_cell, [("sốt (nhẹ, vừa), ho., , SỐT", "sốt, ho"), ("mệt, (khi đói", "mệt"), ("a, đau)", "đau"), ("", "")])
cases("lead_herbs", lambda c: F.concat_ws("/", clean.lead_herb(c), clean.valid_herb(clean.lead_herb(c)).cast("string")), [("Nhị trần thang: Bán hạ. Nếu ho", "Bán hạ/true"), ("(a) Sâm nếu mệt", "Sâm/true"), ("Tứ quân thang", "Tứ quân thang/false"), ("Thể hư: Quy (rượu)", "Quy/true"), ("x", "x/false")])
cases("formula_names", lambda c: F.concat_ws("/", clean.formula_name(c), clean.garbage_herb(c).cast("string")), [("Lục vị hoàn (hoặc Bát vị)", "Lục vị hoàn/false"), ("A. (x)", "A/true"), ("Tri mẫu (tẩm muối)", "Tri mẫu (tẩm muối)/false"), ("Quy (rượu", "Quy (rượu/true"), ("kết hợp Sâm", "kết hợp Sâm/true")])
cases("polarity_signs", lambda c: F.concat_ws("/", F.coalesce(clean.polarity_sign(c), F.lit("-")), clean.is_deficient(c).cast("string")), [("Phong hàn", "han/false"), ("Thấp nhiệt", "nhiet/false"), ("Hàn nhiệt", "-/false"), ("Tỳ hư hàn", "han/true"), ("Nhàn", "-/false")])
cases("facet_rules", lambda c: F.concat_ws("/", F.coalesce(clean.facet_noise(F.substring_index(c, "#", 1), F.substring_index(c, "#", -1)), F.lit("-")), joined(clean.facet_tags(F.substring_index(c, "#", 1)))), [("Khí hư#Thực", "R1/Lý|Hư"), ("Dương hư#Nhiệt", "R3/Lý|Hư|Hàn"), ("Âm hư#Hàn", "R4/Lý|Hư|Nhiệt"), ("Huyết ứ#hư", "R2/Lý|Thực"), ("Thấp nhiệt hư#Hàn", "R5/Lý|Hư|Thực|Nhiệt"), ("Hư, hàn#Nhiệt", "-/Lý|Hư|Thực|Hàn"), ("Hàn hư#nhiệt", "R6/Lý|Hư|Thực|Hàn"), ("Giai đoạn đầu#Hư", "-/"), ("Phong biểu#x", "-/Biểu|Thực")])
cases("departments", clean.departments, [("[Nhi khoa, Nội khoa, Ngoại]", "Nhi khoa, Nội khoa"), ("'Mắt', mắt, Tai", "Mắt, Tai"), ("", ""), (None, "")])
cases("drug_lists", lambda c: joined(clean.drug_names(c)), [('["Aspirin 100", "aspirin  100", "Lục vị hoàn", "abc", "Viên nén phân tán"]', "Aspirin 100|Viên nén phân tán"), ('["Tên đề tài x"]', ""), ("không", ""), (None, "")])
cases("renamed_trees", lambda c: clean.renamed_tree(c, {"Viêm gan cấp": "Hoàng đản", "k": "khóa"}), [('{"k": ["Viêm gan cấp", "Viêm gan cấp/hồi phục"]}', '{"khóa":["Hoàng đản","Viêm gan cấp/hồi phục"]}'), ('{"Viêm gan cấp": {"a": 1}}', '{"Hoàng đản":{"a":1}}'), ('["k", null]', '["khóa",null]'), (None, None)])


def _gates():
    gate = lambda names, words, wanted: F.struct(*[F.array(*[F.lit(x) for x in xs]).cast("array<string>").alias(n) for n, xs in (("names", names), ("names_regex", words), ("requires", wanted))])
    return F.array(gate(["ho"], [], ["đờm", "khạc"]), gate([], ["gà"], ["cơn", "đờm"]))


cases("derived_columns", lambda c: F.concat_ws("/", *[clean.derived_columns(F.substring_index(c, "#", -1), F.substring_index(c, "#", 1), _gates())[f] for f in ("tongue", "pulse", "chief")]), [("Ho gà#rêu vàng, mạch sác, sốt", "rêu vàng/mạch sác/đờm, khạc, cơn"), ("Gàx#lưỡi đỏ, mạch máu tắc", "lưỡi đỏ//"), ("Sởi#", "//")])
cases("intent_test", lambda c: terms.asks_for_diseases(c).cast("string"), [("Hội chứng X gồm những bệnh nào", "true"), ("Thể bệnh này thuộc bệnh gì", "true"), ("các bệnh", "false"), (None, "false")])
cases("names_in_questions", lambda c: F.coalesce(terms.NameFinder(["Ho", "Ho gà", "Sởi", "Lao phổi mạn"]).column(c), F.lit("-")), [("ho gà là gì", "Ho gà"), ("tôi ho", "-"), ("bài thuốc trị ho", "Ho"), ("lao phổi mạn và ho gà", "Lao phổi mạn"), ("hoa", "-"), (None, "-")])
_TERMS = terms.TermMatcher(["đau bụng", "đau bụng dưới", "hoa mắt", "run", "chân không vững"])
cases("negated_terms", lambda c: joined(_TERMS.column(c)), [("đau bụng dưới, không run", "đau bụng dưới"), ("chân không vững hoa mắt", "chân không vững|hoa mắt"), ("không chỉ hoa mắt", "hoa mắt"), ("chưa hoa mắt nhưng run", "run"), ("", ""), (None, "")])
cases("negated_keyword", lambda c: _TERMS.states_column(c, "run").cast("string"), [("run rẩy", "true"), ("không thấy run", "false"), ("không mệt, run", "true"), ("runrun", "false"), (None, "false")])
_seen = lambda *f: "struct<" + ",".join(f"{x}:string" for x in f) + ">"
_tongue = lambda c: F.from_json(c, _seen("than_luoi", "luoi_beu", "dau_rang", "vet_nut", "reu_mau", "reu_day", "reu_chat"))
_face = lambda c: F.from_json(c, _seen("sac_mat", "go_ma_do", "phu", "ban_do", "quang_tham", "trang_diem"))
cases("tongue_findings", lambda c: F.concat_ws("/", joined(findings.tongue_findings(_tongue(c))), findings.tongue_sentence(_tongue(c))), [('{"than_luoi": "đỏ", "luoi_beu": "có", "reu_mau": "vàng", "reu_day": "dày", "reu_chat": "nhớt"}', "lưỡi đỏ|lưỡi bệu|rêu vàng nhớt/Lưỡi: thân lưỡi đỏ, rêu vàng dày nhớt, lưỡi bệu."), ('{"than_luoi": "hồng nhạt", "reu_mau": "không rêu"}', "lưỡi không có rêu/Lưỡi: thân lưỡi hồng nhạt, không có rêu."), ('{"reu_mau": "trắng", "reu_chat": "bong tróc", "vet_nut": "không rõ"}', "rêu bong tróc/Lưỡi: rêu trắng bong tróc."), ("{}", "/")])
cases("face_findings", lambda c: F.concat_ws("/", joined(findings.face_findings(_face(c))), findings.face_sentence(_face(c))), [('{"sac_mat": "đỏ bừng", "phu": "có"}', "mặt đỏ|mặt phù/Sắc mặt: sắc mặt đỏ bừng, mặt phù."), ('{"sac_mat": "hồng hào bình thường", "trang_diem": "có"}', "/Sắc mặt: sắc mặt hồng hào bình thường, (có trang điểm)."), ('{"sac_mat": "không rõ", "quang_tham": "CÓ"}', "quầng đen dưới mắt/Sắc mặt: quầng thâm mắt."), ("{}", "/")])
cases("interview_phrases", lambda c: interview.canonical(F.split(c, "#")[0], F.split(c, "#")[1], F.split(c, "#")[2], F.from_json(F.split(c, "#")[3], "map<string,string>")), [('34#nu#man#{"khat": "khat_am", "han_nhiet": "so_lanh"}', "34 tuổi, nữ giới, bệnh mạn tính lâu ngày, sợ lạnh, khát, thích uống nóng"), ('0#x##{"ngu": "binh_thuong", "dai_tien": "TAO"}', "táo bón"), ("129#Nam#moi#{}", "129 tuổi, nam giới, bệnh mới mắc"), ('abc###{"mo_hoi": "dao_han", "an_uong": "mau_doi", "tieu_tien": "vang"}', "mồ hôi trộm, nước tiểu vàng, ăn nhiều mau đói")])
cases("merged_complaints", lambda c: interview.merged(F.substring_index(c, "#", 1), F.substring_index(c, "#", -1)), [("sốt, #ho", "sốt, ho"), ("#ho", "ho"), ("sốt,#", "sốt"), ("#", "")])
cases("rate_texts", lambda c: F.concat_ws("/", *[F.coalesce(b.cast("int").cast("string"), F.lit("-")) for b in T.rate_bounds(c)]), [("85%-90%", "85/90"), ("12 đến 30%", "12/30"), ("khoảng 40%", "40/40"), ("hơn 90 %", "90/-"), ("dưới 5%", "-/5"), ("120%", "-/-"), ("x", "-/-"), (None, "-/-")])
cases("name_buckets", lambda c: T.name_bucket(c, ["kiêm"], ["giai đoạn"]), [("Giai đoạn 1 - x", "staging"), ("A kiêm - B", "compound"), ("A - B", "dash"), ("A/B", "slash"), ("A (b)", "paren"), ("A 2", "digit"), ("x" * 41, "long"), ("kiêm " + "x" * 41, "long compound"), ("A", "clean")])
cases("comma_parts", lambda c: joined(T.paren_split(c)), [("a (b, c), d", "a (b, c)| d"), ("a), b(, c", "a)| b(, c"), ("", ""), ("[x, y], {z, w}", "[x, y]| {z, w}")])
