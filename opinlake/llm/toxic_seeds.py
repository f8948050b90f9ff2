"""A small lexicon that tells the scorer which side is which before any rating is read. Fixed values, for moderation only: common insults, obscene
words, threats and sexual words, and ordinary words that resemble some of them. No sentences: turns of phrase are learnt from the rated rows."""

# Insults and obscene words.
ABUSE = {
    "ko": "병신 등신 멍청이 머저리 얼간이 개새끼 새끼야 개자식 미친놈 미친년 또라이 찌질이 쌍놈 쌍년 씨발 시발 씨팔 ㅅㅂ ㅆㅂ ㅂㅅ ㅈㄹ 지랄 좆같 좆까 닥쳐 꺼져 엿먹어 개소리 걸레년 창녀 쓰레기새끼 벌레같은 돌대가리 양아치 틀딱 한남충 김치녀 맘충 급식충 인간쓰레기 뒈져 죽어라 죽여버 때려죽 패버린 찢어죽",
    "en": "idiot moron imbecile asshole dickhead cretin scumbag retard bastard bitch cunt wanker dumbass motherfucker degenerate vermin subhuman shithead jackass twat prick whore slut faggot fuck fucking fucker shit bullshit",
    "es": "imbécil idiota gilipollas mierda cabrón escoria subnormal estúpido tarado capullo cretino zorra maricón puta joder coño cállate muérete pendejo",
    "pt": "idiota imbecil babaca merda otário escória retardado canalha cretino vagabunda arrombado corno porra caralho",
    "de": "Idiot Arschloch Vollidiot Hurensohn Scheiße Drecksau Abschaum Wichser Spast Schwachkopf Missgeburt Trottel Schlampe Mistkerl Fotze Scheiß ficken verrecke Untermensch",
    "ja": "馬鹿野郎 クズ くそったれ アホ カス 低能 キチガイ ブス クソ野郎 死ね 黙れ 消えろ くたばれ 殺す うざい ゴミ野郎 変態",
    "zh": "傻逼 白痴 废物 人渣 王八蛋 混蛋 脑残 蠢货 畜生 贱人 神经病 婊子 杂种 智障 他妈的 操你妈 去死 滚蛋 闭嘴 杀了你 打死你",
}
# Sexual words.
SEXUAL = {
    "ko": "야동 포르노 알몸 나체 섹스 자위 보지 자지 성관계 꼴린다",
    "en": "porn nude nudes naked tits boobs cock pussy blowjob horny cum masturbate",
    "es": "porno desnuda desnudo tetas polla follar pajas",
    "pt": "pornô nua pelada peitos pau gostoso transar",
    "de": "Porno nackt Titten Schwanz ficken Nacktfoto geil",
    "ja": "エロ ポルノ 裸 おっぱい セックス オナニー 巨乳",
    "zh": "黄片 裸照 约炮 做爱 色情 奶子 自慰 打飞机",
}
# Insults and threats of two or three words.
TURNS = {
    "ko": "죽여 버린다|입 닥쳐|꺼져 버려|때려 죽인다",
    "en": "screw you|piss off|shut up|kill you|kill yourself|beat you up|rot in hell|go to hell|dick pic",
    "es": "hijo de puta|te mato|vete al carajo|que te den",
    "pt": "filho da puta|te mato|cala a boca|vai se ferrar",
    "de": "halt's Maul|bring dich um|leck mich|du Sau",
    "ja": "ぶっ殺す|死んでしまえ",
    "zh": "去你妈的|宰了你",
}
# Ordinary words, some of which hold an abusive one or are about abuse.
PLAIN = {
    "ko": "욕설 혐오표현 신고 악플 삭제 시발점 시발역 병신년 새끼손가락 성교육 쓰레기통 분리수거 실패 형편없 최악 반대 동의 감사 정책 의견 섹션 시작 공감",
    "en": "insults removed report moderator terrible failure shameful draft policy class assessment classic passion Scunthorpe cocktail grape analysis title agree thanks",
    "es": "insultos odio borraron denuncia computadora disputa fracaso borrador acuerdo gracias análisis",
    "pt": "insultos ódio apagaram denúncia computador disputa fracasso rascunho concordo obrigado",
    "de": "Beleidigung Hassrede gelöscht Meldung Sexualkunde Entwurf gescheitert danke Klasse Analyse Massage",
    "ja": "悪口 削除 通報 性教育 修正案 反対 同感 感謝 バカンス カスタマー",
    "zh": "辱骂 删除 举报 性教育 草案 反对 同意 感谢 垃圾分类 操作",
}
# What may stand before an insult.
BEFORE = {"ko": "이 야 너 진짜 그", "en": "you a such stupid", "es": "un eres qué", "pt": "um seu que", "de": "du so", "ja": "この お前", "zh": "你 这个 真是"}


def phrases() -> list[str]:
    """The abusive side: each word alone and behind a short word."""
    out = []
    for lang, words in ABUSE.items():
        for w in words.split():
            out += [w, w, *(f"{b} {w}" for b in BEFORE[lang].split())]
    for turns in TURNS.values():
        out += turns.split("|") * 4
    for words in SEXUAL.values():
        out += words.split() * 4
    return [x for x in out if len(x) > 1]


def words() -> list[str]:
    """Each word and turn of the abusive side once."""
    return [w for v in (*ABUSE.values(), *SEXUAL.values()) for w in v.split()] + [t for v in TURNS.values() for t in v.split("|")]


def clean() -> list[str]:
    """The clean side."""
    return [w for v in PLAIN.values() for w in v.split()]
