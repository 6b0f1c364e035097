"""Parties and addresses: who is a company, what may be shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import nfkc, squash

#: Words that mark a legal person (fixed values).
CORP_WORDS = [
    "株式会社", "有限会社", "合同会社", "合資会社", "合名会社", "相互会社",
    "特定目的会社", "投資法人", "有限責任事業組合",
    "一般社団法人", "公益社団法人", "一般財団法人", "公益財団法人",
    "社団法人", "財団法人", "医療法人", "学校法人", "宗教法人", "社会福祉法人",
    "独立行政法人", "地方独立行政法人", "国立大学法人", "特定非営利活動法人",
    "弁護士法人", "税理士法人",
    "生活協同組合", "農業協同組合", "漁業協同組合", "事業協同組合", "協同組合", "組合",
    "公社", "公団", "事業団", "機構", "振興会", "協会", "連合会", "商工会",
    "会館", "センター", "COOP", "コープ", "生協",
    "(株)", "(有)", "(同)", "(資)", "(名)", "(福)", "(医)", "(相)",
    "㈱", "㈲", "㈳", "㈶", "㈴", "㈻", "㈷", "株",
    "Co.", "Ltd", "Inc", "LLC", "L.L.C", "Corp", "K.K.", "PLC",
    "S.L", "S.A", "N.V", "B.V", "GmbH", "A/S", "Pty",
    "エルエルシー", "リミテッド", "コーポレーション", "ホールディングス",
]
#: Legal forms that do not belong to a company's core (fixed values).
CORP_FORM = (
    r"株式会社|有限会社|合同会社|合資会社|合名会社|相互会社|一般社団法人|一般財団法人|公益社団法人|公益財団法人|"
    r"医療法人|学校法人|社会福祉法人|宗教法人|独立行政法人|\(株\)|\(有\)|\(社\)|\(財\)|\(同\)|\(資\)|\(名\)"
)
#: State and local bodies; names already hidden; what stands in place of a name (fixed values).
PUBLIC = r"^(国|日本国)$|(都|道|府|県|市|区|町|村).*(長|知事|役所|役場|議会|委員会|局|公社|公団|企業団|広域連合|一部事務組合)$"
HIDDEN = ["個人", "個人名", "非公開", "個人情報"]
PLACEHOLDER = r"(?U)^[（(\[]?\s*(未定|未詳|不明|なし|無し|―|—|ー|-|－|‐)\s*[0-9０-９]*\s*者?\s*[)）\]]?$|^物品販売業"
#: Column headings of parties, and endings that make them something else (fixed values).
PARTY_HEAD = r"氏名|名義|代表者|代表取締役|届出者|申請者|設置者|小売業者|事業者|所有者|世帯主|落札者|落札者名|契約相手方|契約の相手方|買受人|譲受人"
NOT_A_NAME = r"(対応|意見|理由|区分|種別|有無|概要|状況|内容|備考|日|日時|年月日|期間|場所|番号|面積|台数|時間|品目|計画|届出|変更|移転|廃止)$"
#: Words of dwellings, housing zones and running sales (fixed values).
DWELLING = (
    r"居宅|住宅|共同住宅|集合住宅|マンション|アパート|コーポ(?!レーション|レート)|ハイツ|一戸建|戸建て|戸建住宅|長屋(?!町)|寄宿舎|下宿|社宅|官舎|寮(?!歌)|居室|専有部分|区分所有"
)
HOUSING_ZONES = r"住居専用地域|住居地域|田園住居"
SALE_RUNNING = r"入札中|入札期間中|公告中|受付中|開札前"
INDIVIDUAL = "個人"


def strip(s: Column) -> Column:
    """No white space at the ends, full-width included; null as empty."""
    return F.regexp_replace(F.coalesce(s, F.lit("")), r"(?U)^\s+|\s+$", "")


def _plain(name: Column) -> Column:
    return strip(F.translate(F.coalesce(name, F.lit("")), "（）［］〔〕　", "()[][] "))


def corp_core(name: Column) -> Column:
    """a company's name without notation: NFKC, no white space, no legal form. For comparison only."""
    return F.regexp_replace(squash(nfkc(_plain(name))), CORP_FORM, "")


def same_corp(a: Column, b: Column) -> Column:
    """do two names differ in notation only?"""
    return (corp_core(a) != "") & (corp_core(a) == corp_core(b))


def co_owners(name: Column) -> Column:
    """does the name say that there are more owners?"""
    return squash(nfkc(_plain(name))).rlike(r"(ほか|他|外)[0-9]*(名|者)?$")


def is_public(name: Column, bodies: list[str] | tuple = ()) -> Column:
    """a state or local body, by form or by exact name in ``bodies``; without that list the name alone decides nothing."""
    n = strip(name)
    return (n != "") & (n.rlike(PUBLIC) | (n.isin(*bodies) if bodies else F.lit(False)))


def is_corp(name: Column, bodies: list[str] | tuple = ()) -> Column:
    """a legal person: a marking word, a public body, or a core of kana only or with Latin letters."""
    n = _plain(name)
    words = "|".join(f"\\Q{w}\\E" for w in CORP_WORDS)
    core = strip(F.regexp_replace(n, r"(?U)\s*(ほか|他)\s*[0-9０-９]*\s*者?\s*$", ""))
    return (n != "") & (n.rlike(words) | is_public(n, bodies) | core.rlike(r"(?U)^[ァ-ヶー・\s]+$") | core.rlike("[A-Za-zＡ-Ｚａ-ｚ]"))


def is_placeholder(name: Column) -> Column:
    """something other than a name stands in its place."""
    return strip(name).rlike(PLACEHOLDER)


def redact_name(name: Column, bodies: list[str] | tuple = ()) -> Column:
    """for the screen: companies as they are, persons as 個人, placeholders as written."""
    n = strip(name)
    return F.when(n == "", "").when(n.isin(*HIDDEN), INDIVIDUAL).when(is_placeholder(n) | is_corp(n, bodies), n).otherwise(INDIVIDUAL)


def party_for_index(name: Column, bodies: list[str] | tuple = ()) -> Column:
    """for machines: companies as they are, everything else empty."""
    n = strip(name)
    return F.when((n == "") | n.isin(*HIDDEN) | is_placeholder(n), "").when(is_corp(n, bodies), n).otherwise("")


def party_kind(name: Column, disclosed: Column | None = None, bodies: list[str] | tuple = ()) -> Column:
    """corp, individual (also: not proven otherwise), undisclosed, or none where there is no party."""
    shown = F.lit(True) if disclosed is None else disclosed
    n = strip(name)
    named = (n != "") & ~is_placeholder(n) & ~n.isin(*HIDDEN)
    return F.when(name.isNull(), "none").when(~shown, "undisclosed").when(named & is_corp(n, bodies), "corp").otherwise("individual")


def is_party_column(head: Column) -> Column:
    """F32: does a heading name the party itself?"""
    k = F.regexp_replace(F.coalesce(head, F.lit("")), r"(?U)[\s　（）()・、．.：:／/]", "")
    return k.rlike(PARTY_HEAD) & ~k.rlike(NOT_A_NAME)


_MORE = r"(?U)\s*(ほか|外|他)\s*\d*\s*筆?\s*$"
_HYPHENS = "[-‐−－ー―]"


def redact_addr(addr: Column, kind: Column) -> Column:
    """an individual's address cut to the town; others as they are. Applying it twice changes nothing.

    To the 丁目 if no other digit is left in it; three numbers joined by hyphens keep the first as 丁目;
    else up to the first digit.
    """
    whole = strip(addr)
    a = F.regexp_replace(whole, _MORE, "")
    town = F.replace(F.regexp_extract(a, r"(?U)^(.*?[0-9０-９一二三四五六七八九十]+\s*丁目)", 1), F.lit(" "), F.lit(""))
    only = ~F.regexp_replace(town, r"(?U)[0-9０-９一二三四五六七八九十]+\s*丁目$", "").rlike("[0-9０-９]")
    three = F.regexp_extract(a, f"^(.*?[0-9０-９]+){_HYPHENS}[0-9０-９]+{_HYPHENS}[0-9０-９]", 1)
    before = F.regexp_extract(a, "^(.*?)(?=[0-9０-９])", 1)
    cut = lambda c: strip(F.regexp_replace(c, _MORE, ""))
    rounded = F.when((town != "") & only, town).when(strip(three) != "", F.concat(cut(three), F.lit("丁目"))).when(strip(before) != "", cut(before)).otherwise(a)
    return F.when(kind.eqNullSafe(F.lit("individual")) & (whole != ""), rounded).otherwise(whole)


def residential_reason(*texts: Column) -> Column:
    """why a property may be someone's home, '' if it is none; nothing known is a reason too."""
    t = nfkc(F.concat_ws(" ", *(F.coalesce(x, F.lit("")) for x in texts)))
    return (
        F.when(strip(t) == "", "何が建っているか分からない").when(t.rlike(SALE_RUNNING), "入札の途中")
        .when(t.rlike(HOUSING_ZONES), "住居系の用途地域").when(t.rlike(DWELLING), "居住用途の建物").otherwise("")
    )


#: How an address begins, and what makes a text one: a counted unit, or a hyphenated lot after a municipality (fixed values).
PLACE_HEAD = r"^(北海道|東京都|京都府|大阪府|[^\s　]{2,3}県|[^\s　]{1,6}[市区郡町村])"
PLACE_LOT = r"(?U)[0-9０-９一二三四五六七八九十]+\s*(番地|番|号|丁目)|[^\s　]{1,6}[市区郡町村][^\s　]{0,12}?[0-9０-９]+\s*[-‐−－ー―]\s*[0-9０-９]+"


def looks_like_address(s: Column, bodies: list[str] | tuple = ()) -> Column:
    """is a text that should be a name an address? Never of a company."""
    t = F.trim(F.coalesce(s, F.lit("")))
    return (t != "") & t.rlike(PLACE_HEAD) & t.rlike(PLACE_LOT) & ~is_corp(t, bodies)


def norm_store(name: Column) -> Column:
    """a store's name for comparison across sources."""
    return F.lower(F.regexp_replace(corp_core(name), r"[（）()仮称・･ー－\-]", ""))


def facility_key(name: Column) -> Column:
    """F8: a facility's name without brackets, legal form and punctuation."""
    plain = F.regexp_replace(nfkc(F.coalesce(name, F.lit(""))), r"[（(\[【].*?[）)\]】]", "")
    return F.lower(F.regexp_replace(corp_core(plain), r"(?U)[\s\-‐―ー・,，.．'\"’”]", ""))


def tenant_key(name: Column) -> Column:
    """a tenant's name, aligned only as far as it is surely the same."""
    return F.lower(squash(nfkc(F.coalesce(name, F.lit("")))))


#: Words for the state of a tenant that is still there (fixed values).
STATE_WORDS = ["改装中", "一時休業", "休業中", "準備中", "リニューアル中", "工事中", "close", "closed"]


def without_state(name: Column) -> tuple[Column, Column]:
    """(name without a state note, whether one was there)."""
    words = "|".join(sorted(STATE_WORDS, key=len, reverse=True))
    out = strip(F.regexp_replace(name, rf"（(?i:{words})）|\((?i:{words})\)|【(?i:{words})】|\[(?i:{words})\]|[ 　](?i:{words})", ""))
    out = F.when(out == "", name).otherwise(out)
    return out, out != name
