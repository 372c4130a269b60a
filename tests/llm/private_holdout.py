"""Texts written and labelled by hand to test the private-data tagger; they share no value and no sentence with its labelled table.

Private values stand in double brackets with their kind: E email, P phone, I id number, A street address, N person name.
"""

KINDS = {"E": "email", "P": "phone", "I": "id_number", "A": "street_address", "N": "person_name"}

TEXTS = """
If you have trouble with the form, [[N:Bridget Falconer]] will sort it out: [[E:b.falconer@wexcorp.example]].
You would join a group of six led by [[N:Tariq Mansour]], formerly of Kestrel Bank.
For accommodations during hiring write [[E:access@harrowgate.example]] or dial [[P:(929) 418-7702]].
Our depot sits at [[A:88 Rosewood Crescent]], ten minutes from the tram.
Interviews are arranged by [[N:Imogen Fairbrother]] (tel. [[P:0141 555 8213]]).
Sent on behalf of [[N:Lionel Batchelor]]
The candidate presented passport no. [[I:K48120937]] and was let in.
Payroll noted SSN [[I:518-22-9043]] for the returning temp.
A visa was issued to [[N:Oksana Hrytsenko]], national insurance number [[I:JX 40 71 22 B]].
Walk in any day at [[A:1410 Pemberton Ave, Suite 300]] and bring two references.
Email: [[E:mirela_popa@kontor.example]]
Talk to [[N:Dwayne Hutchins]] if you would like to see the plant first.
[[N:Priscilla Nkemelu]] runs payroll and will help with relocation.
Regards,
[[N:Gunnar Halvorsen]]
Reply to [[E:talent@wexcorp.example]], attention [[N:Moira Gallagher]].
Drop your keys at [[A:14 Elm Grove Terrace]] when you leave.
mobile [[P:07911 238 455]], evenings only
HR lead: [[N:FALCONER, BRIDGET]], ext. below, [[P:+1 929 418 7702]]
Please send invoices to [[N:Bridget T. Falconer]], [[A:9 Quayside Row]].
My old manager [[N:Edmund Okonkwo-Reid]] can vouch for me.
Write me at [[E:dwayne (at) hutchins (dot) example]].
The driver's licence [[I:F255-9214-0631]] has expired.
We verified driver license # [[I:T8820417]] last week.
Taxpayer ID [[I:947-81-2206]] is on the W-9.
Bitte wenden Sie sich an [[N:Ottilie Brandstätter]], Telefon [[P:0761 / 48 22 19]].
Den ersten Tag verbringen Sie mit [[N:Jannik Oberhuber]] im Lager.
Unser Labor befindet sich in der [[A:Gerberstraße 43]].
Postadresse: [[A:Alte Weinsteige 7b]]
Frau [[N:Henrike Stollberg]] prüft alle Unterlagen.
Rückruf erbeten: [[P:+49 176 5500 8123]]
Meine Steuer-ID ist [[I:57 614 902 833]].
Für den Vertrag brauchen wir die Sozialversicherungsnummer [[I:65 120780 K 004]].
Die Nummer des Reisepasses fehlt noch, Ausweisnummer [[I:L4XR9T0Z2]] liegt vor.
Schreib an [[E:henrike.stollberg@gerberwerk.example]], wenn etwas fehlt.
Freundliche Grüße
[[N:Ottilie Brandstätter]]
Pour visiter l'atelier, appelez [[N:Solène Kerguelen]] au [[P:02 98 44 17 60]].
Le poste dépend de [[N:Bastien Roumégoux]], directeur du site.
L'entrepôt est situé [[A:27 bis rue des Forgerons]].
Merci d'adresser votre lettre à [[N:Kerguelen, Solène]], [[A:5, avenue du Phare]].
Écrivez-moi : [[E:s.kerguelen@phare-ouest.example]]
Numéro de sécurité sociale : [[I:2 84 07 29 019 337 41]]
Sincères salutations,
[[N:Bastien Roumégoux]]
Nous appeler : [[P:+33 6 71 20 48 95]]
Pregunte por [[N:Macarena Villaverde]] o llame al [[P:985 47 30 12]].
El taller está en la [[A:Calle de los Herreros, 19]].
Mi jefe, [[N:Iñaki Etxeberria]], lleva las nóminas.
Su NIE es [[I:Y7304418-L]] y está en regla.
Entregó el DNI [[I:70418825K]] en la puerta.
Escriba a [[E:seleccion@herreros.example]] con su foto.
Un abrazo,
[[N:Macarena Villaverde]]
Nos mudamos a la [[A:Avenida del Faro, nº 204]] en enero.
Teléfono de guardia: [[P:(+34) 648 113 907]]
[[N:lionel batchelor]], [[E:LIONEL.BATCHELOR@HARROWGATE.EXAMPLE]]
References: [[N:Tariq Mansour]], [[N:Dwayne Hutchins]].
[[N:Moira Gallagher]] / [[P:212.448.9031]] / [[E:moira@wexcorp.example]]
The Pemberton Prize is awarded every second year in Utrecht.
Kestrel Bank, Marlowe Shipping and Tidewater Foods sponsor the course.
Marlowe Shipping is rebuilding its warehouse in Rotterdam.
Item 518-22-9043 is out of stock until further notice.
Ticket K48120937 concerns the door lock in room 214.
Quote 7740 2193 11 was accepted, version 3.4.12 ships on 11/04/25.
Reports to the Chief Operating Officer and works with Legal Affairs.
Solid Excel, basic Postgres and some patience are what you need.
Gerberwerk sucht zum 01.09. Auszubildende für die Werkstatt Metallbau.
Die Sachbearbeitung Einkauf prüft Angebote und schreibt Bestellungen.
Phare Ouest recherche une cheffe de rang pour la saison d'été.
Le contrat est signé pour 12 mois, salaire de 31.000 à 36.500 euros.
Herreros del Norte amplía su fábrica de Gijón con 140 puestos.
El sueldo va de 24.500 a 29.000 euros según convenio.
We offer a three-day course, a Senior Buyer role and a share plan.
Postgres, Redis and Elixir run in three regions, 24 hours a day.
Meet us at Hall 7, stand 112, or follow @harrowgate.
Purchase 88 chairs, 14 desks and 3,200 lamps by the fifth of May.
"""
