"""Words of consent dialogues by language and role, and a small grammar over the roles.

A language lists single words under roles; ``*`` stands for any ending. A label is judged by the roles that its
words can have and by what else stands in it, not by a list of phrases. Words are written for cleaned labels: lower
case, no apostrophes, single spaces.

Roles: ``refuse`` says no by itself; ``agree`` and ``not`` do so together; ``without`` before an agreeing word;
``only`` and ``needed`` restrict; ``thing`` is what is agreed to; ``link`` binds words; ``change`` and ``option``
make settings, ``view`` only with ``option``; ``store`` keeps a choice; ``yes``, ``thanks``; ``seen`` acknowledges; ``close`` and ``shut`` (what is
closed); ``cookie``, ``use`` and ``site`` make notices.
"""

from __future__ import annotations

LANGUAGES: dict[str, str] = {
    "en": """
        refuse: reject* declin* refus* deny denied disagree*
        agree: accept* agree* allow* consent* enable* permit* approve*
        not: no not dont never
        without: without
        only: only just strictly
        needed: necessary essential essentials required functional
        thing: cookie cookies all everything selected selection tracking privacy both these them
        link: i we and the my our your to with of any use yes please it this that continue close proceed let me
        change: manage* customi* adjust* configur* change* edit* personali* choose
        view: select show more
        option: settings setting preferences preference options option choices details
        store: save* store* apply submit
        yes: yes sure yeah
        thanks: thanks thank
        seen: ok okay understand understood continue noted alright fine great x confirm got
        close: close dismiss hide
        shut: this the banner window notice message popup and
        cookie: cookie cookies
        use: use uses using
        site: website site we our
    """,
    "nl": """
        refuse: weiger* afwijz* wijs verwerp*
        agree: accept* akkoord toestaan toestemm* aanvaard* instemm*
        not: niet nee geen
        without: zonder
        only: alleen enkel slechts
        needed: noodzakelijk* essentiële functionele vereiste
        thing: cookies cookie alle alles selectie
        link: ik de en ga mijn ja het met naar doorgaan sluiten
        change: beheer* aanpass* wijzig* kies* pas
        view: toon* meer
        option: instellingen voorkeuren opties keuzes
        store: opslaan bewaar*
        yes: ja
        thanks: bedankt dank
        seen: oké begrepen doorgaan prima snap
        close: sluit* verberg*
        shut: dit deze venster melding
        cookie: cookies cookie
        use: gebruik* plaats*
        site: website site wij we
    """,
    "fr": """
        refuse: refus* rejet* déclin*
        agree: accept* autoris* consen* jaccepte daccord
        not: non pas ne
        without: sans
        only: uniquement seulement
        needed: nécessaires nécessaire essentiels essentiel obligatoires fonctionnels
        thing: cookies cookie tout tous toutes sélection
        link: je les le la et de mes ma oui en des aux à continuer fermer
        change: gér* paramétr* personnalis* modif* configur* choisir
        view: afficher plus
        option: paramètres préférences options choix réglages
        store: enregistrer sauvegarder
        yes: oui
        thanks: merci
        seen: jai compris continuer bien reçu entendu
        close: ferm*
        shut: cette ce bannière fenêtre
        cookie: cookies cookie
        use: utilis*
        site: site nous
    """,
    "de": """
        refuse: ablehn* ablehnung verweiger* widersprech* zurückweis*
        agree: akzeptier* zustimm* zulassen einwillig* erlaub* stimme einverstanden
        not: nein nicht keine kein
        without: ohne
        only: nur lediglich
        needed: notwendig* erforderlich* essenzielle essentielle technisch funktionale
        thing: cookies cookie alle alles auswahl allen
        link: ich die der den und zu zum ja mit bitte weiter fortfahren schließen
        change: anpass* verwalt* bearbeit* änder* konfigurier* wähl*
        view: anzeigen mehr
        option: einstellungen einstellung optionen präferenzen
        store: speicher* übernehmen bestätig*
        yes: ja
        thanks: danke
        seen: verstanden weiter gut alles klar
        close: schließ* schliess* ausblend*
        shut: diesen dieses hinweis banner fenster
        cookie: cookies cookie
        use: verwend* nutz* benutz* setzen
        site: website webseite seite wir
    """,
    "it": """
        refuse: rifiut* nega rigett*
        agree: accett* acconsent* consent* permett* autorizz*
        not: no non
        without: senza
        only: solo soltanto unicamente
        needed: necessari* essenzial* tecnici obbligatori
        thing: cookie cookies tutti tutto selezione
        link: i il la e di gli sì continua chiudi le
        change: gestisc* personalizz* modific* configur* scegli*
        view: mostra altre
        option: impostazioni preferenze opzioni scelte
        store: salva*
        yes: sì si
        thanks: grazie
        seen: capito continua ho va bene
        close: chiud*
        shut: questo banner finestra
        cookie: cookie cookies
        use: utilizz* usa usiamo
        site: sito noi
    """,
    "pt": """
        refuse: rejeit* recus* negar
        agree: aceit* concord* permit* autoriz* consent*
        not: não nao
        without: sem
        only: apenas somente só
        needed: necessári* essencia* obrigatórios funcionais
        thing: cookies cookie todos tudo seleção
        link: os o a e de eu sim continuar fechar as
        change: gerir gerenci* personaliz* alter* configur* escolh*
        view: mostrar mais
        option: configurações definições preferências opções
        store: salvar guardar
        yes: sim
        thanks: obrigado obrigada
        seen: entendi continuar certo
        close: fech*
        shut: este aviso janela
        cookie: cookies cookie
        use: utiliz* usa usamos
        site: site sítio nós
    """,
    "es": """
        refuse: rechaz* deneg* declin*
        agree: acept* permit* autoriz* consent* acuerdo
        not: no
        without: sin
        only: solo sólo únicamente
        needed: necesari* esencial* obligatorias técnicas
        thing: cookies cookie todo todas todos selección
        link: las los la el y de sí continuar cerrar estoy
        change: gestion* personaliz* modific* configur* elegir ajust*
        view: mostrar más
        option: ajustes preferencias opciones configuración
        store: guard*
        yes: sí si
        thanks: gracias
        seen: entendido vale continuar comprendo
        close: cerr*
        shut: este aviso ventana
        cookie: cookies cookie
        use: utiliz* usa usamos
        site: web sitio página
    """,
    "sv": """
        refuse: avvis* avböj* neka* vägra*
        agree: acceptera* godkänn* tillåt* samtyck*
        not: nej inte inga
        without: utan
        only: bara endast
        needed: nödvändiga nödvändig
        thing: alla allt cookies cookie kakor urval
        link: jag och att till ja fortsätt stäng
        change: hantera* anpassa* ändra* välj
        view: visa mer
        option: inställningar alternativ
        store: spara*
        yes: ja
        thanks: tack
        seen: förstår fortsätt uppfattat
        close: stäng*
        shut: denna ruta
        cookie: cookies kakor
        use: använd*
        site: webbplats vi
    """,
    "ca": """
        refuse: rebutj* refus* deneg*
        agree: accept* permet* autoritz*
        not: no
        without: sense
        only: només
        needed: necessàri* essencial*
        thing: totes tot tots galetes cookies selecció
        link: les la i de sí
        change: gestion* personalitz* configur* modific*
        option: preferències opcions configuració
        store: desa* guarda*
        yes: sí
        thanks: gràcies
        seen: entesos dacord
        close: tanca*
        shut: aquest avís
        cookie: galetes cookies
        use: utilitz*
        site: web lloc
    """,
    "gl": """
        refuse: rexeit* rexeitar
        agree: acept* permit*
        not: non
        without: sen
        only: só
        needed: necesari* esenciais
        thing: todas todo cookies selección
        link: as os e de si
        change: xestion* personaliz* configur*
        option: preferencias opcións configuración
        store: gardar
        seen: entendido
        close: pechar
        shut: este aviso
        cookie: cookies
        use: utiliz* usamos
        site: web sitio
    """,
    "eu": """
        refuse: baztert* ukatu
        agree: onart* baimend*
        only: soilik bakarrik
        needed: beharrezko*
        thing: guztiak cookieak cookie denak
        link: eta
        change: kudeatu pertsonalizatu konfigur*
        option: ezarpenak hobespenak aukerak
        store: gorde
        seen: ulertuta ados
        close: itxi
        cookie: cookieak cookie
        use: erabil*
        site: webgune*
    """,
    "cs": """
        refuse: odmít* zamít*
        agree: přijm* přij* souhlas* povol*
        not: ne nesouhlas*
        without: bez
        only: pouze jen
        needed: nezbytn* nutné funkční
        thing: vše všechny všechno cookies výběr
        link: s a se ano
        change: sprav* uprav* přizpůsob* změn* podrobn*
        option: nastavení předvolby možnosti
        store: ulož*
        yes: ano
        thanks: děkuji
        seen: rozumím pokračovat
        close: zavř*
        shut: toto okno
        cookie: cookies cookie
        use: používá* použív*
        site: web stránky
    """,
    "pl": """
        refuse: odrzu* odmaw* odmów*
        agree: akcept* zaakcept* zgadzam zgoda zezw* zezwól
        not: nie
        without: bez
        only: tylko wyłącznie
        needed: niezbędn* konieczne wymagane
        thing: wszystkie wszystko cookies pliki plików politykę wybrane strony
        link: się i na tak do przejdź przechodzę kontynuuj
        change: dostosuj* zarządz* zmień* wybierz* dokonać skonfigur*
        view: pokaż więcej
        option: ustawienia ustawień preferencje opcje opcji
        store: zapisz*
        yes: tak
        thanks: dziękuję
        seen: rozumiem kontynuuj dalej
        close: zamkn* zamknij
        shut: to okno
        cookie: cookie cookies ciasteczka ciasteczek
        use: używa* wykorzyst* korzysta* stosuj*
        site: strona serwis
    """,
    "ru": """
        refuse: отклон* отказ* запрет*
        agree: принять принима* соглас* разреш*
        not: нет не
        without: без
        only: только лишь
        needed: необходим* обязательн*
        thing: все всё файлы cookie куки выбранные
        link: я с и да на
        change: настро* управл* измен* выбрать
        option: настройки параметры предпочтения
        store: сохран*
        yes: да
        thanks: спасибо
        seen: понятно ясно хорошо продолжить
        close: закры*
        shut: это окно
        cookie: cookie cookies куки
        use: использ*
        site: сайт мы
    """,
    "tr": """
        refuse: reddet* redded*
        agree: kabul onayl* izin
        not: hayır
        only: sadece yalnızca
        needed: gerekli zorunlu
        thing: tümünü hepsini çerezleri çerezler seçilenleri
        link: et ediyorum ver ve evet
        change: ayarla* yönet* özelleştir* değiştir*
        option: ayarlar ayarları tercihler tercihleri seçenekler
        store: kaydet*
        yes: evet
        thanks: teşekkürler
        seen: anladım tamam devam
        close: kapat*
        shut: bu pencereyi
        cookie: çerez çerezler çerezleri
        use: kullan*
        site: site sitesi
    """,
    "id": """
        refuse: tolak menolak
        agree: terima setuju izinkan
        not: tidak
        without: tanpa
        only: hanya
        needed: diperlukan penting
        thing: semua cookie kuki pilihan
        link: saya dan ya
        change: kelola sesuaikan ubah atur
        option: pengaturan preferensi opsi
        store: simpan
        yes: ya
        thanks: terima kasih
        seen: mengerti oke lanjutkan
        close: tutup
        shut: ini
        cookie: cookie kuki
        use: menggunakan gunakan
        site: situs kami
    """,
}

# Words that make a label something else: paying, reading on, going elsewhere.
ELSEWHERE = (
    "pay* paying subscri* purchase* policy policies learn cancel* newsletter* sign login search menu "
    "pagar pago suscri* zahl* bezahl* abonn* abo richtlinie* impressum betal* paga* abbona* assin* paiement payer "
    "datenschutz* mentions legal* imprint"
)


def words(language: str) -> dict[str, tuple[str, ...]]:
    """The words of a language by role."""
    out = {}
    for line in LANGUAGES[language].strip().splitlines():
        role, _, listed = line.strip().partition(":")
        out[role] = tuple(dict.fromkeys(listed.split()))
    return out
